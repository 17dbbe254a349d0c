"""Registered queries over whole tables, and their SQL where SQL can express them."""

import hashlib

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from linkloom.llm import (
    chat,
    decontam,
    langid,
    lines,
    lm,
    pieces,
    quality,
    repeats,
    resample,
    secrets,
    simhash,
    spelling,
    urls,
)
from linkloom.llm.sampling_sql import OP12_SQL, OP13_SQL

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
CHAT_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")

# The rules that the URL query applies, as (action, host, path).
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
# Host labels whose pages make up the block list of the URL query.
BAD_LABELS = ["ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm"]


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def _joined_sha(ids):
    return F.sha2(F.array_join(ids, ","), 256)


def _remainder(doc_id, by: int):
    return F.crc32(F.col(doc_id).cast("string")) % by


def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict on every document, learnt from all of them."""
    return quality.classify(_read(spark, folder, "documents"))


def op2_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of ids and decoded text of every document."""
    return pieces.encode_and_decode(_read(spark, folder, "documents"), PIECE_MODEL)


def op4_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    """Base and model score of every document; one remainder in seven is held out."""
    docs = _read(spark, folder, "documents").select("doc_id", "text")
    held_out = F.coalesce(_remainder("doc_id", 7) == 2, F.lit(False))
    scored = lm.score_texts(docs, ~held_out, PIECE_MODEL)
    return scored.select(
        "doc_id",
        held_out.alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )


def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document; one remainder in three is held out."""
    docs = _read(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(_remainder("doc_id", 3) == 1, F.lit(False))
    book = langid.train_codebook(docs.where(~held_out & F.col("lang").isNotNull()))
    found = langid.identify(docs, book)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "ambiguous")


def op7_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of every formatted conversation, read back from what formatting gives."""
    rows = _read(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    probe = r"\### Assistant: </turn> ok"
    added = spark.createDataFrame(
        [(-7, 0, "user", probe), (-7, 1, "assistant", probe)],
        "conv_id bigint, turn bigint, role string, text string",
    )
    made = chat.format_chats(rows.unionByName(added), CHAT_TOKENIZER)

    def run(batches):
        for batch in batches:
            out = [[], [], [], [], []]
            names = ("formatted", "token_starts", "token_ends", "loss_mask", "spans")
            for text, starts, ends, mask, spans in zip(
                *(batch.column(n).to_pylist() for n in names)
            ):
                turns = chat.read_back(text)
                lines_of = "".join(f"{role}\n{said}\n" for role, said in turns)
                under = "".join(
                    chat.loss_pieces(text, starts, ends, mask, [(s["from"], s["to"]) for s in spans])
                )
                out[0].append(len(turns))
                out[1].append(hashlib.sha256(lines_of.encode()).hexdigest())
                out[2].append(len(under))
                out[3].append(hashlib.sha256(under.encode()).hexdigest())
                out[4].append(len(text))
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), *(pa.array(c, k) for c, k in zip(out, kinds))],
                ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
            )

    return made.mapInArrow(
        run,
        "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
        "loss_sha256 string, formatted_chars bigint",
    )


def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and verdict of every document."""
    return lines.judge_lines(_read(spark, folder, "documents"))


def op3_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Words that each document keeps."""
    kept = repeats.remove_repeats(_read(spark, folder, "documents"))
    return kept.select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


def op6_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and group of every document."""
    grouped = simhash.near_duplicates(_read(spark, folder, "documents"))
    return grouped.select(
        "doc_id", simhash.fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id"
    )


def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Contaminated words and items of every document."""
    judged = decontam.decontaminate(
        _read(spark, folder, "documents"), _read(spark, folder, "benchmark")
    )
    return judged.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        _joined_sha(F.col("items")).alias("items_sha256"),
        "contaminated",
    )


def op10_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict on every page; the list holds all URLs seen on bad hosts."""
    pages = _read(spark, folder, "pages")
    host = urls.host_of(F.col("url"))
    bad = F.arrays_overlap(F.split(host, r"\."), F.array(*map(F.lit, BAD_LABELS)))
    judged = urls.judge_urls(pages, pages.where(bad).select("url"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "listed")


def op11_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and places of possible secrets in every document."""
    found = secrets.find_secrets(
        _read(spark, folder, "documents"), RANKS, public_tokenizers.PATTERN
    )

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda s: s["kind"] != secrets.RANDOM)
    return found.select(
        "doc_id",
        count(secrets.ASSIGN).alias("n_assign"),
        count(secrets.ACCESS).alias("n_access"),
        count(secrets.HEX).alias("n_hex"),
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed("spans").alias("spans"),
    )


def op12_spelling(spark: SparkSession, folder: str) -> DataFrame:
    """Form and root of every word of the documents, with one run in 97 misspelt."""
    return spelling.group_variants(_read(spark, folder, "documents"), drop_every=97)


def op13_resampling(spark: SparkSession, folder: str) -> DataFrame:
    """Weight, score and rank of every document in a draw towards the benchmark's texts."""
    return resample.resample(_read(spark, folder, "documents"), _read(spark, folder, "benchmark"))


OP3_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id,
  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT rid, doc_id, s, array_to_string(w[s:s + 12], ' ') AS t
  FROM (SELECT *, unnest(generate_series(1, len(w) - 12)) AS s FROM d WHERE len(w) >= 13)
),
first AS (SELECT t, min(doc_id) AS least FROM win GROUP BY t HAVING min(doc_id) < max(doc_id)),
gone AS (
  SELECT DISTINCT rid, unnest(generate_series(s, s + 12)) AS p
  FROM win JOIN first USING (t) WHERE least < doc_id
),
kept AS (
  SELECT rid, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS words
  FROM (SELECT rid, unnest(w) AS word, unnest(generate_series(1, len(w))) AS p FROM d)
  ANTI JOIN gone USING (rid, p) GROUP BY rid
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, len(w) - coalesce(n, 0) AS n_removed,
  sha256(coalesce(words, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (rid)
"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TERMS = (
    f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

# Fixed value: the row that the chat query adds to the conversations, twice.
OP7_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
),
t AS (SELECT *, regexp_replace(text, '(\\*)(###|</turn>)', '\\\1\2', 'g') AS safe FROM rows)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(4 + length(role) + 2 + length(safe) + 9) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""

OP8_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_TERMS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_TERMS} AS w FROM benchmark),
win AS (
  SELECT item, least(len(w), 10) AS n, array_to_string(w[s:s + least(len(w), 10) - 1], ' ') AS t
  FROM (SELECT item, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS s FROM b WHERE len(w) > 0)
),
lens AS (SELECT DISTINCT n FROM win),
dw AS (
  SELECT rid, s, n, array_to_string(w[s:s + n - 1], ' ') AS t
  FROM (SELECT rid, w, n, unnest(generate_series(1, len(w) - n + 1)) AS s
        FROM d CROSS JOIN lens WHERE len(w) >= n)
),
hit AS (SELECT dw.rid, dw.s, dw.n, win.item FROM dw JOIN win USING (n, t)),
words AS (
  SELECT rid, count(DISTINCT p) AS n_hit
  FROM (SELECT rid, unnest(generate_series(s, s + n - 1)) AS p FROM (SELECT DISTINCT rid, s, n FROM hit))
  GROUP BY rid
),
items AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT rid, item FROM hit WHERE item IS NOT NULL) GROUP BY rid
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (rid) LEFT JOIN items USING (rid)
"""

_FITS = " ".join(
    f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{a} {h}{p}'"
    for a, h, p in sorted(URL_RULES, key=lambda r: -len(r[1]) - len(r[2]))
)
_LABELS = ", ".join(f"'{x}'" for x in BAD_LABELS)

OP10_SQL = rf"""
WITH p AS (
  SELECT page_id, url,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{_UPPER}', '{_LOWER}') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
    list_sort(list_filter(
      string_split(coalesce(regexp_extract(url, '(?s)^.*?://[^?#]*\?([^#]*)', 1), ''), '&'),
      lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[^=]*|ref|gclid|fbclid)(=|$)'))) AS kept
  FROM pages
),
c AS (
  SELECT *, CASE WHEN contains(url, '://') THEN
    regexp_replace(host, '^www\.', '') || regexp_replace(path, '/$', '')
    || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END END AS canonical,
    CASE {_FITS} END AS fit
  FROM p
),
listed AS (
  SELECT DISTINCT canonical FROM c
  WHERE canonical IS NOT NULL AND list_has_any(string_split(host, '.'), [{_LABELS}])
)
SELECT page_id, host, path, split_part(fit, ' ', 2) AS rule,
  CASE WHEN fit IS NOT NULL THEN split_part(fit, ' ', 1)
    WHEN listed.canonical IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict,
  listed.canonical IS NOT NULL AS listed
FROM c LEFT JOIN listed ON c.canonical = listed.canonical
"""


def llm_queries():
    """Queries by name."""
    return {
        "op1_quality": op1_quality,
        "op2_sentencepiece": op2_sentencepiece,
        "op3_substring_dedup": op3_substring_dedup,
        "op4_lm_scoring": op4_lm_scoring,
        "op5_language_id": op5_language_id,
        "op6_simhash": op6_simhash,
        "op7_chat_formatting": op7_chat_formatting,
        "op8_decontamination": op8_decontamination,
        "op9_quality_rules": op9_quality_rules,
        "op10_url_filters": op10_url_filters,
        "op11_secrets": op11_secrets,
        "op12_spelling": op12_spelling,
        "op13_resampling": op13_resampling,
    }


def llm_oracle_sql():
    """SQL by query name."""
    return {
        "op3_substring_dedup": OP3_SQL,
        "op7_chat_formatting": OP7_SQL,
        "op8_decontamination": OP8_SQL,
        "op10_url_filters": OP10_SQL,
        "op12_spelling": OP12_SQL,
        "op13_resampling": OP13_SQL,
    }
