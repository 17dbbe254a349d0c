"""Conversations, URLs, the queries with SQL, and the pipeline."""

import hashlib
import os

import brute
import pytest
from odd_rows import FOLDER, documents, edge_rows, edges, engine, nothing  # noqa: F401
from hypothesis import HealthCheck, given, settings, strategies as st

import __spark_entry__ as registry
import corpus_pipeline
import numpy as np
import public_tokenizers
import sentencepiece
from linkloom.llm import chat, quality, simhash, urls
from linkloom.llm.queries import URL_RULES, llm_oracle_sql
from linkloom.sources.workspace import scope

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("name", llm_oracle_sql())
def test_query_against_sql(spark, engine, name):
    frame = registry.queries()[name](spark, FOLDER)
    cursor = engine.execute(registry.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(frame.columns) == sorted(columns)
    want = sorted(map(repr, cursor.fetchall()))
    assert sorted(repr(tuple(r)) for r in frame.select(*columns).collect()) == want
    assert want


def test_all_ten_queries_and_the_pipeline_are_registered():
    names = set(registry.queries())
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
    assert "pipeline" in names


# --- chat

NASTY = ["", "\\", "\\\\### x", "### user:\n", "\n</turn>\n", "</turn>", "\\</turn>", "\n", " \n ", "é😀", "###" * 3]


@settings(max_examples=200, deadline=None)
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["user", "assistant", "", "a\nb\\", "x:"]),
            st.one_of(st.sampled_from(NASTY), st.text(st.sampled_from("\\#</turn>\n :a"), max_size=20)),
        ),
        max_size=5,
    )
)
def test_rendering_is_reversible(turns):
    formatted, spans = chat.render(turns)
    assert chat.read_back(formatted) == turns
    said = [t for r, t in turns if r == "assistant"]
    assert [chat.unescape(formatted[a:b]) for a, b in spans] == said


def test_chats_on_odd_rows(spark):
    rows = [
        (1, 1, "assistant", "second"), (1, 0, "user", "first"), (1, 1, "assistant", "also second"),
        (2, None, None, None), (2, 0, "assistant", None), (2, 0, "assistant", None),
        (None, 0, "assistant", "no id"), (None, 1, "user", "either"),
        (3, 0, "assistant", "w " * 20_000), (4, 0, "user", "only a user"),
        *[(5, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(NASTY)],
    ]
    frame = spark.createDataFrame(
        [(*r, "x", "y") for r in rows],
        "conv_id long, turn long, role string, text string, turns string, formatted string",
    )
    got = {r["conv_id"]: r for r in chat.format_chats(frame, TOKENIZER).collect()}
    assert len(got) == 6
    for conv, out in got.items():
        own = [(t, r or "", x or "") for c, t, r, x in rows if c == conv]
        own.sort(key=lambda v: (v[0] is not None, v))
        assert chat.read_back(out["formatted"]) == [(r, x) for _, r, x in own]
        spans = [(s["from"], s["to"]) for s in out["spans"]]
        pieces = chat.loss_pieces(
            out["formatted"], out["token_starts"], out["token_ends"], out["loss_mask"], spans
        )
        assert pieces == [x for _, r, x in own if r == "assistant"]
        for start, end, masked in zip(out["token_starts"], out["token_ends"], out["loss_mask"]):
            assert masked == any(start < b and a < end for a, b in spans if a < b)
    assert chat.format_chats(frame.limit(0), TOKENIZER).collect() == []


# --- urls

ODD_URLS = [
    None, "", "no scheme", "http://", "://", "HTTP://Example.COM/en/x", "http://www.example.com/en/",
    "http://a.net/es/1?utm_source=x", "https://a.net/es", "x://evilexample.com/en/", "http://com/",
    "http://com", "http://a.com?b#c", "http://bad.org/p/?b=2&a=1&utm_medium=m#f", "https://www.bad.org/p?a=1&b=2",
    "http://bad.org/P?a=1&b=2", "ftp://q.org/a://b.com/en/", "http://bad.org/p\n/x",
]


def plain_host_and_path(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    path = rest[cut:]
    end = min([path.find(c) for c in "?#" if c in path] or [len(path)])
    return brute.lower(rest[:cut]), path[:end]


@pytest.mark.parametrize("blocks", [urls.MAX_BLOCKS, 1])
def test_urls_on_odd_rows(spark, monkeypatch, blocks):
    monkeypatch.setattr(urls, "MAX_BLOCKS", blocks)
    pages = spark.createDataFrame(
        [(i, u, "clash", "clash", "clash") for i, u in enumerate(ODD_URLS + ODD_URLS[-5:])],
        "page_id int, url string, host string, block string, listed string",
    )
    extra = [(f"http://l{i}.org/{i}",) for i in range(300)]
    listed = spark.createDataFrame(
        [("http://bad.org/p?a=1&b=2",), ("http://bad.org/p?b=2&a=1",), (None,), ("plain",), *extra], "url string"
    )
    got = sorted(urls.judge_urls(pages, listed, URL_RULES).collect())
    assert len(got) == len(ODD_URLS) + 5
    for row in got:
        url = (ODD_URLS + ODD_URLS[-5:])[row["page_id"]]
        host, path = plain_host_and_path(url)
        assert (row["host"], row["path"]) == (host, path), url
        fits = [
            (h + p, a) for a, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)
        ]
        rule = max(fits, key=lambda f: len(f[0]), default=(None, None))
        on_list = url in (ODD_URLS[13], ODD_URLS[14])
        assert row["rule"] == rule[0] and row["listed"] == on_list, url
        assert row["verdict"] == (rule[1] or ("block" if on_list else "allow"))
    nobody = urls.judge_urls(pages, listed.limit(0), ())
    assert nobody.where("verdict = 'block'").count() == 0
    assert urls.judge_urls(pages.limit(0), listed, URL_RULES).collect() == []


def test_native_operators_run_no_python(spark):
    for name in ("op8_decontamination", "op10_url_filters"):
        text = registry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in text and "InArrow" not in text and "InPandas" not in text


# --- pipeline


def test_pipeline_against_plain_python(spark, documents, engine):
    """Each stage redone one text at a time; the classifier's verdicts are taken as they are."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    good = {r["doc_id"] for r in quality.classify(docs).where("kept").collect()}
    rows = [(i, t) for i, t in documents if i in good]
    marks = {i: brute.fingerprint(t) for i, t in rows}
    groups = {
        r["doc_id"]: r["component_id"]
        for r in simhash.near_duplicates(docs.where(docs.doc_id.isin(list(good)))).collect()
    }
    ids = sorted(marks)
    for at, a in enumerate(ids):
        for b in ids[at + 1 :]:
            if (marks[a] ^ marks[b]).bit_count() <= 2:
                assert groups[a] == groups[b]
    rows = [(i, t) for i, t in rows if groups[i] == i]
    kept = [
        (i, t if not removed else None, ws)
        for (i, t), (_, removed, ws) in zip(rows, brute.kept_words(rows))
        if not removed or ws
    ]
    items = engine.execute("SELECT item_id, text FROM benchmark").fetchall()
    hit = brute.hits([(i, " ".join(ws)) for i, _, ws in kept], items)
    kept = [row for row, h in zip(kept, hit) if not h[1]]
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, FOLDER).collect()}
    assert set(got) == {i for i, _, _ in kept} and len(got) < len(documents)
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for i, text, ws in kept:
        if text is not None:
            assert got[i]["token_ids"] == [1, *library.encode(text), 2]
        else:
            assert brute.words(library.decode(got[i]["token_ids"])) == ws
        packed = np.array(got[i]["token_ids"], "<u4").tobytes()
        assert got[i]["ids_sha256"] == hashlib.sha256(packed).hexdigest()


def test_stages_take_odd_rows(spark, edges, nothing):
    columns = list(corpus_pipeline.COLUMNS)
    assert len(corpus_pipeline.STAGES) == 5
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, edges, FOLDER)
        assert out.count() <= len(edge_rows())
        assert name == "sentencepiece" or out.columns == columns
        assert stage(spark, nothing, FOLDER).collect() == []


def test_queries_leave_nothing_in_a_scope(spark, monkeypatch):
    """Tables that lazy results read go with the scope, and with a failing stage of the pipeline."""
    root = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(root))
    for name in ("op3_substring_dedup", "op6_simhash", "op8_decontamination", "op12_spelling", "op13_resampling"):
        with scope():
            assert registry.queries()[name](spark, FOLDER).count() > 0
            assert set(os.listdir(root)) > before
        assert set(os.listdir(root)) <= before, name

    def fails(spark, docs, sf_dir):
        raise ZeroDivisionError

    stages = [corpus_pipeline.STAGES[2], ("broken", fails)]
    monkeypatch.setattr(corpus_pipeline, "STAGES", stages)
    with pytest.raises(ZeroDivisionError):
        corpus_pipeline.run(spark, FOLDER)
    assert set(os.listdir(root)) <= before
    monkeypatch.setattr(corpus_pipeline, "STAGES", stages[:1] * 2)
    with scope():
        kept = corpus_pipeline.run(spark, FOLDER)
        assert kept.count() > 0 and len(set(os.listdir(root)) - before) == 1
    assert set(os.listdir(root)) <= before
