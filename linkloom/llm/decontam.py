"""Benchmark decontamination by a positional inverted index.

A test phrase is found by the postings of its rarest terms: each posting
(term, document, position), less the term's offset in the phrase, gives a place
where the phrase would start, and only places that all of these terms name go on.
What is left is compared with the document word by word, so matches are exact.
The index is a stored table and holds the terms that phrases are looked up by.
"""

from pyspark.sql import Column, DataFrame, functions as F

from linkloom.llm.tables import lower_ascii, small_or_shuffled
from linkloom.sources.workspace import Workspace

WINDOW = 10
# Terms per phrase whose posting lists are intersected, rarest first.
RAREST = 2

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def terms(text: Column) -> Column:
    """Words of a text with A-Z lowered: digits, letters, and all beyond ASCII. NULL: none."""
    split = F.split(lower_ascii(F.coalesce(text, F.lit(""))), SEPARATORS, -1)
    return F.array_remove(split, "")


def occurrences(docs: DataFrame, wanted: DataFrame | None = None, n_wanted: int = 0) -> DataFrame:
    """(term, doc_id, pos) of every word in ``docs`` (doc_id, text), or of the wanted terms."""
    every = docs.select("doc_id", F.posexplode(terms(F.col("text"))).alias("pos", "term"))
    if wanted is None:
        return every.select("term", "doc_id", "pos")
    return every.join(small_or_shuffled(wanted.select("term"), n_wanted), "term").select(
        "term", "doc_id", "pos"
    )


def build_index(
    docs: DataFrame, work: Workspace, wanted: DataFrame | None = None, n_wanted: int = 0
) -> DataFrame:
    """Store the postings of the wanted terms (None: of all) and return the table."""
    return work.store(occurrences(docs, wanted, n_wanted), "postings")[0]


def proximity_matches(index: DataFrame, first: str, second: str, within: int) -> DataFrame:
    """(doc_id, first_pos, second_pos) of each ``second`` at most ``within`` words from a ``first``.

    Positions are joined by blocks of ``within`` words, next blocks included, so
    no document's lists meet pair by pair.
    """
    step = max(1, within)
    a = index.where(F.col("term") == first).select(
        "doc_id",
        F.col("pos").alias("first_pos"),
        F.explode(F.array(*(F.floor(F.col("pos") / step) + d for d in (-1, 0, 1)))).alias("block"),
    )
    b = index.where(F.col("term") == second).select(
        F.col("doc_id").alias("__doc"),
        F.col("pos").alias("second_pos"),
        F.floor(F.col("pos") / step).alias("__block"),
    )
    near = F.abs(F.col("first_pos") - F.col("second_pos")) <= within
    other = F.col("first_pos") != F.col("second_pos")
    return a.join(
        b,
        F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("block") == F.col("__block")) & near & other,
    ).select("doc_id", "first_pos", "second_pos")


def _passages(items: DataFrame, work: Workspace) -> tuple[DataFrame, dict]:
    """Distinct word lists of the items with the ids that have them, numbered."""
    lists = (
        items.select(F.col("item_id").cast("string").alias("item_id"), terms(F.col("text")).alias("words"))
        .where(F.size("words") > 0)
        .groupBy("words")
        .agg(F.collect_set("item_id").alias("items"))
    )
    return work.store(
        lists.withColumn("passage", F.monotonically_increasing_id()),
        "passages",
        n_words=F.coalesce(F.sum(F.size("words")), F.lit(0)),
    )


def _seeds(passages: DataFrame, counts: DataFrame, window: int, rarest: int) -> DataFrame:
    """(term, passage, start, q, rank): by which terms each window is looked up.

    A window with a term that no document has cannot occur and has no seeds.
    """
    placed = passages.select("passage", F.posexplode("words").alias("q", "term")).join(
        counts, "term", "left"
    )
    spots = placed.groupBy("passage").agg(
        F.array_sort(
            F.collect_list(F.struct("q", F.coalesce("n", F.lit(0)).alias("n"), "term"))
        ).alias("spots")
    )
    last = F.greatest(F.size("spots") - window, F.lit(0))
    windows = spots.select(
        "passage", "spots", F.explode(F.sequence(F.lit(0), last)).alias("start")
    ).select("passage", "start", F.slice("spots", F.col("start") + 1, window).alias("spots"))
    possible = windows.where(~F.exists("spots", lambda s: s["n"] == 0))
    ranked = F.slice(
        F.array_sort(F.transform("spots", lambda s: F.struct(s["n"], s["q"], s["term"]))), 1, rarest
    )
    return (
        possible.select("passage", "start", ranked.alias("ranked"))
        .select("passage", "start", F.size("ranked").alias("lists"), F.posexplode("ranked").alias("rank", "s"))
        .select(
            F.col("s.term").alias("term"),
            "passage",
            "start",
            "lists",
            "rank",
            (F.col("s.q") - F.col("start")).alias("offset"),
        )
    )


def find_windows(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, rarest: int = RAREST
) -> DataFrame:
    """(doc_id, found): where windows of the items may occur in documents, by the index.

    ``found`` lists, per passage, its words, item ids and (start, at) pairs: the
    window's start in the passage and in the document. ``docs`` has doc_id, text; rows with the same
    doc_id share one list, so it should tell rows with different texts apart.
    """
    work = Workspace(docs.sparkSession)
    passages, size = _passages(items, work)
    vocabulary, known = work.store(
        passages.select(F.explode("words").alias("term")).distinct(), "vocabulary", n=F.count("*")
    )
    counts, _ = work.store(
        occurrences(docs, vocabulary, known["n"]).groupBy("term").agg(F.count("*").alias("n")),
        "counts",
    )
    seeds, sown = work.store(_seeds(passages, counts, window, rarest), "seeds", n=F.count("*"))
    wanted, n = work.store(seeds.select("term").distinct(), "wanted", n=F.count("*"))
    index = build_index(docs, work, wanted, n["n"])
    work.drop("vocabulary", "counts", "wanted")
    places = (
        index.join(small_or_shuffled(seeds, sown["n"]), "term")
        .select("doc_id", "passage", "start", "lists", "rank", (F.col("pos") - F.col("offset")).alias("at"))
        .where("at >= 0")
        .groupBy("doc_id", "passage", "start", "at", "lists")
        .agg(F.bit_or(F.expr("shiftleft(1, rank)")).alias("seen"))
        .where(F.expr("seen = shiftleft(1, lists) - 1"))
    )
    per_passage = places.groupBy("doc_id", "passage").agg(
        F.collect_list(F.struct("start", "at")).alias("spots")
    )
    found = F.struct("words", "items", "spots")
    return (
        per_passage.join(small_or_shuffled(passages, size["n_words"]), "passage")
        .groupBy("doc_id")
        .agg(F.collect_list(found).alias("found"))
    )


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    rarest: int = RAREST,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry=(),
) -> DataFrame:
    """Words of each document inside any occurrence of a benchmark window.

    ``items`` has item_id and text. A window is ``window`` consecutive words of an item; an item of fewer,
    but not none, is one window. Returns id, n_words, n_hit, items (ids, sorted
    as strings) and contaminated (any hit).

    NULL and empty texts have no words: a document is clean, an item finds
    nothing. Rows that share an id are judged each by its own text, NULL ids too. Items
    without an id hit but are not listed. Columns named in ``carry`` come along as they are,
    others are not read.
    """
    extra = [f"carry_{i}" for i in range(len(carry))]
    own = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(text_col).alias("text"),
        *(F.col(c).alias(e) for c, e in zip(carry, extra)),
    )
    # Lists are kept by id and text: rows without id, or that share one, do not meet in one list. Equal rows
    # share a list, and rows whose keys collide share places that the comparison below tells apart.
    row_key = F.xxhash64("doc_id", "text")
    texts = own.select(row_key.alias("doc_id"), "text")
    found = find_windows(texts, items.select("item_id", "text"), window, rarest)
    rows = own.join(
        found.withColumnRenamed("doc_id", "__row"), row_key == F.col("__row"), "left"
    ).select("doc_id", terms(F.col("text")).alias("words"), "found", *extra)

    def same(passage, spot):
        length = F.least(F.size(passage["words"]), F.lit(window))
        return F.slice(F.col("words"), spot["at"] + 1, length) == F.slice(
            passage["words"], spot["start"] + 1, length
        )

    exact = F.filter(
        F.transform(
            F.coalesce("found", F.array()),
            lambda p: F.struct(
                p["items"].alias("items"),
                F.least(F.size(p["words"]), F.lit(window)).alias("length"),
                F.filter(p["spots"], lambda s: same(p, s)).alias("spots"),
            ),
        ),
        lambda p: F.size(p["spots"]) > 0,
    )
    covered = F.array_distinct(
        F.flatten(
            F.transform(
                "exact",
                lambda p: F.flatten(
                    F.transform(
                        F.array_distinct(F.transform(p["spots"], lambda s: s["at"])),
                        lambda at: F.sequence(at, at + p["length"] - 1),
                    )
                ),
            )
        )
    )
    listed = F.array_sort(F.array_distinct(F.flatten(F.transform("exact", lambda p: p["items"]))))
    return rows.select(
        "doc_id", F.size("words").alias("n_words"), exact.alias("exact"), *extra
    ).select(
        F.col("doc_id").alias(id_col),
        F.col("n_words").cast("long"),
        F.size(covered).cast("long").alias("n_hit"),
        listed.alias("items"),
        (F.size("exact") > 0).alias("contaminated"),
        *(F.col(e).alias(c) for c, e in zip(carry, extra)),
    )
