"""Operators on texts against the contracts in plain Python, on odd rows and on the test documents."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from odd_rows import FOLDER, TEXTS, documents, edges, engine, nothing, union_find  # noqa: F401
from pyspark.sql import functions as F

import __spark_entry__ as registry
from linkloom.llm import decontam, langid, lines, lm, pieces, quality, repeats, runs, simhash, tables, words

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def query(spark, name):
    return registry.queries()[name](spark, FOLDER).collect()


def key(value):
    return [(v is None, v) for v in value]


# --- substring dedup


def test_repeats_on_odd_rows(edges):
    got = repeats.remove_repeats(edges, carry=("lang", "carry_0")).collect()
    want = [
        (i, n, r, " ".join(k)) for (i, _), (n, r, k) in zip(TEXTS, brute.kept_words(TEXTS))
    ]
    found = [(r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in got]
    assert sorted(found, key=key) == sorted(want, key=key)
    assert sum(r > 0 for _, _, r, _ in want) >= 4
    assert {(r["lang"], r["carry_0"]) for r in got} == {("en", "clash")}
    texts = {(r["doc_id"], r["kept"]): r["kept_text"] for r in got}
    for (i, text), (_, removed, kept) in zip(TEXTS, brute.kept_words(TEXTS)):
        out = texts[i, " ".join(kept)]
        assert brute.words(out) == kept and (removed or out == text)


@pytest.mark.parametrize("length, anchor", [(13, 5), (4, 2), (3, 3), (5, 1)])
def test_repeats_of_any_length(spark, length, anchor):
    random = np.random.default_rng(length)
    docs = [(i, " ".join(random.choice(list("abc"), random.integers(0, 40)))) for i in range(40)]
    frame = spark.createDataFrame(docs, "doc_id int, text string")
    got = repeats.remove_repeats(frame, length, anchor).collect()
    want = [(i, r, " ".join(k)) for (i, _), (_, r, k) in zip(docs, brute.kept_words(docs, length))]
    assert sorted((r["doc_id"], r["n_removed"], r["kept"]) for r in got) == sorted(want)


def test_window_starts_as_bits(spark):
    """Stretches that overlap, come again, or cross the borders of blocks."""
    pick = random.Random(4)
    for length in (1, 3, 13):
        sizes = [200, 64, 63, 65, 128, 1]
        rows = []
        for tag, n in enumerate(sizes):
            for _ in range(6):
                pos = pick.randrange(max(1, n - length + 1))
                if n >= length:
                    rows.append((tag, pos, pick.randint(1, n - length + 1 - pos)))
        rows += rows[:5] * 3
        found = repeats.start_blocks(spark.createDataFrame(rows, "tag long, pos int, size int")).collect()
        for r in found:
            n = sizes[r["tag"]]
            want = {i for tag, pos, size in rows if tag == r["tag"] for i in range(pos, pos + size + length - 1)}
            covered = repeats.covered_words(n, r["blocks"], length)
            assert set(np.flatnonzero(covered).tolist()) == want
            assert len(r["blocks"]) <= n // 64 + 1


def test_repeats_of_many_equal_rows(spark):
    """Copies under one id share one list of bits, and texts under one id are told apart by 64 bits."""
    shared = " ".join(f"w{i}" for i in range(30))
    docs = [(1, f"start {shared} end")] + [(7, f"copy {shared} of it")] * 1000
    docs += [(7, f"number {i} {shared if i % 2 else 'without'} x{i}") for i in range(200)] + [(None, shared)] * 50
    got = repeats.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    want = [(i, n, r, " ".join(k)) for (i, _), (n, r, k) in zip(docs, brute.kept_words(docs))]
    found = [(r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in got]
    assert sorted(found, key=key) == sorted(want, key=key)
    blocks = repeats.start_blocks(
        repeats.repeated_stretches(
            spark.createDataFrame(docs, "doc_id long, text string").withColumn("tag", F.xxhash64("doc_id", "text"))
        )
    )
    assert blocks.count() == 101 and blocks.agg(F.max(F.size("blocks"))).first()[0] == 1


def test_full_filter_changes_nothing(spark, documents, monkeypatch):
    """A filter that lets most seeds pass costs rows, not results."""
    frame = spark.createDataFrame(documents, "doc_id long, text string")
    want = sorted(map(tuple, repeats.remove_repeats(frame).collect()))
    monkeypatch.setattr(repeats, "MAX_FILTER_WORDS", 1)
    assert sorted(map(tuple, repeats.remove_repeats(frame).collect())) == want


def test_repeats_in_nothing(nothing):
    assert repeats.remove_repeats(nothing).collect() == []


# --- simhash


def test_simhash_on_odd_rows(edges):
    got = simhash.near_duplicates(edges).collect()
    marks = [brute.fingerprint(t) for _, t in TEXTS]
    near = [
        (a, b)
        for a, b in itertools.combinations(range(len(marks)), 2)
        if (marks[a] ^ marks[b]).bit_count() <= 2
    ]
    roots = union_find(len(TEXTS), near)
    least = {
        r: min((TEXTS[i][0] for i in range(len(TEXTS)) if roots[i] == r and TEXTS[i][0] is not None), default=None)
        for r in roots
    }
    want = [(TEXTS[i][0], marks[i], least[roots[i]]) for i in range(len(TEXTS))]
    found = [(r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in got]
    assert sorted(found, key=key) == sorted(want, key=key)
    kept = simhash.one_of_each(edges)
    assert kept.columns == edges.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert len(ids) == len(set(ids)) and set(ids) >= {1, 4, 9, 10, 12} and not {2, 3, 13} & set(ids)


def test_one_row_of_every_group(spark, edges):
    """Groups of rows without id, and groups that share an id, keep one document each."""
    rows = [(None, f"word{i} and others like number{i} of{i} them{i}") for i in range(30)]
    rows += [(77, f"text{i} under one id with words{i} of{i} its{i} own{i}") for i in range(10)]
    rows += [(None, "a copy of a text that has an id"), (5, "a copy of a text that has an id")] * 2
    more = spark.createDataFrame(rows, "doc_id long, text string")
    docs = edges.select("doc_id", "text").unionByName(more)
    marks = {brute.fingerprint(t): 0 for _, t in TEXTS + rows}
    roots = union_find(len(marks), [
        (a, b) for (a, x), (b, y) in itertools.combinations(enumerate(marks), 2) if (x ^ y).bit_count() <= 2
    ])
    group = dict(zip(marks, roots))
    kept = simhash.one_of_each(docs, unique_ids=False).collect()
    assert sorted(group[brute.fingerprint(r["text"])] for r in kept) == sorted(set(roots))
    least = {}
    for i, t in TEXTS + rows:
        at = group[brute.fingerprint(t)]
        least[at] = min(least.get(at, (True, 0)), (i is None, i or 0))
    assert all(least[group[brute.fingerprint(r["text"])]] == (r["doc_id"] is None, r["doc_id"] or 0) for r in kept)
    once = [r["doc_id"] for r in simhash.one_of_each(docs).collect()]
    assert once.count(77) == 1 and once.count(None) == sum(r["doc_id"] is None for r in kept) >= 30


def test_golay_keys_meet_within_two_bits():
    table = simhash.correction_table()
    random = np.random.default_rng(4)
    marks = random.integers(0, 2**64, 400, dtype=np.uint64)
    for a, b in itertools.combinations_with_replacement(range(0, 64, 3), 2):
        other = marks ^ np.uint64(1 << a | 1 << b)
        ours, theirs = ({}, {})
        for marks_of, keys_of in ((marks, ours), (other, theirs)):
            for row, k in zip(*simhash.fingerprint_keys(marks_of, table)):
                keys_of.setdefault(row, set()).add(int(k))
        assert all(ours[i] & theirs[i] for i in ours)
        assert max(map(len, ours.values())) <= 18


@pytest.mark.parametrize("bucket", [64, 3, 1])
def test_links_connect_all_near_fingerprints(spark, bucket):
    """Chains and dense clusters, with keys below and above the bucket size."""
    random = np.random.default_rng(9)
    marks = set(map(int, random.integers(0, 2**64, 60, dtype=np.uint64)))
    for seed in list(marks)[:6]:
        mark = seed
        for _ in range(25):
            bits = random.integers(0, 64, 2)
            mark = (seed if random.random() < 0.5 else mark) ^ (1 << int(bits[0])) ^ (1 << int(bits[1]))
            marks.add(mark)
    marks = sorted(marks)
    signed = [m - 2**64 if m >= 2**63 else m for m in marks]
    work = simhash.Workspace(spark)
    frame = spark.createDataFrame([(s,) for s in signed], "fp long")
    pairs = simhash.links(frame, work, bucket).collect()
    at = {s: i for i, s in enumerate(signed)}
    got = union_find(len(marks), [(at[a], at[b]) for a, b in pairs])
    want = union_find(
        len(marks),
        [(a, b) for a, b in itertools.combinations(range(len(marks)), 2) if (marks[a] ^ marks[b]).bit_count() <= 2],
    )
    assert got == want and len(set(want)) < len(marks)


def test_simhash_of_the_documents(spark, documents):
    got = {r["doc_id"]: r for r in query(spark, "op6_simhash")}
    marks = [brute.fingerprint(t) for _, t in documents]
    near = [
        (a, b)
        for a, b in itertools.combinations(range(len(marks)), 2)
        if (marks[a] ^ marks[b]).bit_count() <= 2
    ]
    roots = union_find(len(marks), near)
    assert near and len(got) == len(documents)
    for i, (doc, _) in enumerate(documents):
        assert got[doc]["fingerprint"] == f"{marks[i]:016x}"
        assert got[doc]["component_id"] == min(documents[j][0] for j in range(len(marks)) if roots[j] == roots[i])


def test_simhash_of_nothing(nothing):
    assert simhash.near_duplicates(nothing).collect() == []
    with pytest.raises(ValueError):
        simhash.near_duplicates(nothing, max_bits=3)


# --- sentencepiece


def test_pieces_on_odd_rows(edges, nothing):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    got = pieces.encode_and_decode(edges, MODEL, with_ids=True, with_text=True, block_bytes=1000)
    want = []
    for i, text in TEXTS:
        ids = [1, *library.encode(text or ""), 2]
        want.append((i, len(ids), ids, library.decode(ids)))
    found = [(r["doc_id"], r["n_tokens"], r["token_ids"], r["decoded"]) for r in got.collect()]
    assert sorted(found, key=key) == sorted(want, key=key)
    assert pieces.encode_and_decode(nothing, MODEL).collect() == []


def test_pieces_of_the_documents(spark, documents):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    got = {r["doc_id"]: r for r in query(spark, "op2_sentencepiece")}
    for doc, text in documents:
        ids = [1, *library.encode(text or ""), 2]
        assert got[doc]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[doc]["decoded_sha256"] == brute.sha(library.decode(ids))
        assert got[doc]["n_tokens"] == len(ids)


def test_table_that_starts_anew(documents, monkeypatch):
    monkeypatch.setattr(pieces, "MOST_CHUNKS", 50)
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    table = pieces.ChunkTable(pieces.load(MODEL))
    for _, text in documents[:30]:
        table = table.renewed()
        ((ids, decoded),) = pieces.encode_block([text], table)
        assert list(ids) == [1, *library.encode(text), 2] and decoded == library.decode(list(map(int, ids)))


# What a cut or a joined line could get wrong: markers, line feeds, spelled control pieces, rare letters.
PARTS = (
    " ", "  ", "\n", "\n\n", "▁", "▁▁", "a", "the", "hello world", "é", "\u0301", "€", "𝄞", "日本",
    "\ufffd", "\t", "\r", "\x0b", "\x00", "\x85", "<0x0A>", "<s>", "</s>", "<unk>", "1", "'",
)


def test_blocks_of_random_texts(monkeypatch):
    monkeypatch.setattr(pieces, "LINES", 3)
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    pick = random.Random(5)
    table = pieces.ChunkTable(pieces.load(MODEL))
    for _ in range(40):
        texts = ["".join(pick.choices(PARTS, k=pick.randint(0, 40))) for _ in range(25)]
        for text, (ids, decoded) in zip(texts, pieces.encode_block(texts, table)):
            want = [1, *library.encode(text), 2]
            assert ids.tolist() == want and decoded == library.decode(want)


def test_chunks_cover_the_text():
    for text in (" ", "a  b", "\n\n x\n", "▁▁", "é \n"):
        assert "".join(pieces.chunks(text)) == " " + text.replace("▁", " ")


def test_chunks_end_where_no_piece_can_cross():
    pick = random.Random(8)
    parts = ["a", " ", "\n", "é", "▁", "bc", "  ", "😀"]
    for _ in range(200):
        texts = ["".join(pick.choices(parts, k=pick.randint(0, 12))) for _ in range(pick.randint(0, 6))]
        texts += [None] * pick.randint(0, 2)
        found, counts = pieces.cut_chunks(pa.array(texts, pa.string()))
        want = [re.findall(" *[^ \n]+| +|\n+", " " + t.replace("▁", " ")) if t else [] for t in texts]
        assert found.to_pylist() == list(itertools.chain(*want)) and counts.tolist() == list(map(len, want))


# --- decontamination

ITEMS = [
    (1, " ".join(f"shared{i}" for i in range(5, 25))),
    (2, "One, TWO!"),
    (3, None),
    (4, "..."),
    (5, "never to be found"),
    (None, "naïve"),
    (6, " ".join(f"shared{i}" for i in range(5, 25))),
    (6, "lazy dog it sleeps"),
]


@pytest.mark.parametrize("rarest", [1, 2, 10])
def test_decontamination_on_odd_rows(spark, edges, rarest):
    items = spark.createDataFrame(ITEMS, "item_id int, text string").withColumn("words", F.lit(1))
    got = decontam.decontaminate(edges, items, rarest=rarest, carry=("words", "lang")).collect()
    want = [(i, *h, bool(h[1])) for (i, _), h in zip(TEXTS, brute.hits(TEXTS, ITEMS))]
    found = [
        (r["doc_id"], r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in got
    ]
    assert sorted(found, key=key) == sorted(want, key=key)
    assert {(r["words"], r["lang"]) for r in got} == {("clash", "en")}
    assert any(w[3] == ["1", "6"] for w in want) and any(w[2] and not w[3] for w in want)


def test_decontamination_of_rows_without_own_id(spark):
    """Hundreds of rows without id and under one id, each with a passage at another place."""
    passage = " ".join(f"bench{i}" for i in range(60))
    docs = [(i, "pad " * k + passage) for k in range(150) for i in (None, 5)] + [(None, "clean text")] * 50
    docs += [(5, f"x {passage}")] * 100
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    items = [(1, passage), (2, "one two three")]
    got = decontam.decontaminate(frame, spark.createDataFrame(items, "item_id int, text string")).collect()
    want = [(i, *h, bool(h[1])) for (i, _), h in zip(docs, brute.hits(docs, items))]
    found = [(r["doc_id"], r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in got]
    assert sorted(found, key=key) == sorted(want, key=key)
    texts = frame.select(F.xxhash64("doc_id", "text").alias("doc_id"), "text")
    lists = decontam.find_windows(texts, spark.createDataFrame(items, "item_id int, text string"))
    spots = lists.select(F.size(F.element_at("found", 1)["spots"]).alias("n"), F.size("found").alias("p"))
    assert spots.agg(F.max("n"), F.max("p"), F.count("*")).first() == (51, 1, 301)


def test_decontamination_without_items_or_documents(spark, edges, nothing):
    items = spark.createDataFrame(ITEMS, "item_id int, text string")
    assert decontam.decontaminate(nothing, items).collect() == []
    clean = decontam.decontaminate(edges, items.limit(0))
    assert clean.where("contaminated").count() == 0 and clean.count() == len(TEXTS)


def test_proximity_matches(spark):
    docs = spark.createDataFrame([(1, "a x x b x a b"), (2, "b a"), (3, "a")], "doc_id int, text string")
    index = decontam.occurrences(docs)
    for within in (1, 2, 3, 10):
        got = sorted(map(tuple, decontam.proximity_matches(index, "a", "b", within).collect()))
        a, b = {1: [0, 5], 2: [1], 3: [0]}, {1: [3, 6], 2: [0], 3: []}
        assert got == sorted((d, p, q) for d in a for p in a[d] for q in b[d] if abs(p - q) <= within)


# --- language model


def test_base_scores_of_odd_rows(edges, nothing):
    """With frequent words in the tasks, and with all words looked up."""
    learn = F.col("doc_id") % 2 == 0
    counts = Counter()
    for i, text in TEXTS:
        if i is not None and i % 2 == 0:
            counts.update([*brute.words(brute.lower(text)), None])
    n, kinds = sum(counts.values()), len(counts)
    want = []
    for i, text in TEXTS:
        tokens = [*brute.words(brute.lower(text)), None]
        base = sum(math.log10((counts[t] + 1) / (n + kinds + 1)) for t in tokens)
        want.append((i, len(tokens), sum(counts[t] > 0 for t in tokens), n, round(base, 5)))
    for frequent in (300_000, 1):
        got = lm.score_texts(edges, learn, MODEL, frequent=frequent).collect()
        by_row = [
            (r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5))
            for r in got
        ]
        # Rows that share id and text were one row each.
        assert sorted(by_row, key=key) == sorted(want, key=key)
        assert all(r["score"] < 0 for r in got)
    assert lm.score_texts(nothing, learn, MODEL).collect() == []


def test_run_hashes_tell_runs_by_their_bytes():
    pick = random.Random(3)
    texts = ["", "a", "a\0", "\0", "é", "x" * 8, "x" * 9, "x" * 16, *(c * n for c in "xy" for n in (512, 513, 3000))]
    texts += ["".join(pick.choices("ab\0é", k=pick.randrange(40))) for _ in range(3000)]
    data, offsets = runs.text_bytes(pa.array([*texts, *texts[::-1]], pa.string()))
    hashes = words.run_hashes(data, offsets[:-1], offsets[1:])
    assert list(hashes[: len(texts)]) == list(hashes[len(texts) :][::-1])
    assert len(set(hashes.tolist())) == len(set(texts))
    # A run's place does not count.
    assert words.run_hashes(data[3:].copy(), offsets[9:-1] - 3, offsets[10:] - 3).tolist() == hashes[9:].tolist()


def test_hashed_chunks_have_the_ids_of_the_library(documents, monkeypatch):
    """Also where the table starts anew, and where a task goes on with that of another."""
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = ["", "\n\n", "  a  b\n", "▁a ▁", "é\0", "\t x\r\n y", *[t for _, t in documents[:300]], ""]
    want = [[sp.bos_id(), *sp.encode(brute.lower(t or "")), sp.eos_id()] for t in texts]
    monkeypatch.setattr(pieces, "MOST_HASHED", 500)
    monkeypatch.setattr(pieces, "_left", {})
    seen = set()
    for _ in range(2):
        got = []
        with pieces.kept_table(MODEL) as held:
            for i in range(0, len(texts), 40):
                held[0] = held[0].renewed()
                seen.add(id(held[0]))
                got += [list(ids) for ids in lm.subword_ids(texts[i : i + 40], held[0])]
        assert got == want
        assert [*pieces._left.values()] == held
    assert len(seen) > 1
    with pytest.raises(ValueError), pieces.kept_table(MODEL):
        raise ValueError
    assert not pieces._left


def test_ids_are_counted_over_whole_batches(spark):
    rows = [(i, i % 3 > 0, bytearray(lm.pack_ids([i % 7, i % 5, 9]))) for i in range(60)]
    frame = spark.createDataFrame(rows, "doc_id int, learn boolean, ids binary")
    want = Counter(n for i in range(60) if i % 3 for n in (i % 7, i % 5, 9))
    assert lm._id_counts(frame, 12).tolist() == [want[n] for n in range(12)]
    assert not lm._id_counts(frame.where("doc_id < 0"), 12).any()


@pytest.fixture(scope="module")
def model(documents):
    loaded = pieces.load(MODEL)
    ids = lm.subword_ids([t for _, t in documents], pieces.ChunkTable(loaded, decode=False))
    train = [i for i, (d, _) in zip(ids, documents) if zlib.crc32(str(d).encode()) % 7 != 2]
    held = [i for i, (d, _) in zip(ids, documents) if zlib.crc32(str(d).encode()) % 7 == 2]
    counts = np.bincount(np.concatenate(train), minlength=loaded.get_piece_size()).astype(float)
    kinds, shares = lm.id_classes(counts, [loaded.id_to_piece(i) for i in range(len(counts))])
    attention = lm.Attention(len(counts)).train(train, kinds, rounds=150)
    return lm.Scorer(attention, kinds, shares), counts, held


def test_windows_score_each_id_once(model):
    scorer, _, held = model
    for ids in [*held[:4], held[0][:2], held[1][: lm.WINDOW + 1], held[2][: lm.WINDOW + 2]]:
        total = 0
        for t in range(1, len(ids)):
            start = max(0, -(-(t - lm.WINDOW) // lm.STEP)) * lm.STEP
            logs, _ = scorer.model.forward(ids[None, start:t])
            assert np.isclose(np.exp(logs[0, -1]).sum(), 1, atol=1e-4)
            total += logs[0, -1, scorer.kinds[ids[t]]] / np.log(10) + scorer.shares[ids[t]]
        assert np.isclose(scorer.score([ids])[0], total, rtol=1e-4)
    assert np.allclose(scorer.score(held), [scorer.score([i])[0] for i in held], rtol=1e-4)


def test_ids_of_a_class_share_its_chance(model):
    scorer, _, _ = model
    assert np.allclose(np.bincount(scorer.kinds, 10**scorer.shares), 1)


def test_model_beats_unigrams_on_held_out_texts(model):
    scorer, counts, held = model
    unigram = np.log10((counts + 1) / (counts + 1).sum())
    assert scorer.score(held).sum() > sum(unigram[i[1:]].sum() for i in held)


def test_attention_is_causal(model):
    scorer, _, held = model
    ids = np.concatenate(held)[: lm.WINDOW][None].copy()
    before, _ = scorer.model.forward(ids)
    ids[0, 20:] = 7
    after, _ = scorer.model.forward(ids)
    assert np.allclose(before[0, :20], after[0, :20]) and not np.allclose(before[0, 20:], after[0, 20:])


def test_gradients_by_differences():
    random = np.random.default_rng(0)
    net = lm.Attention(50)
    ids, targets = random.integers(0, 50, (3, lm.WINDOW)), random.integers(0, lm.CLASSES, (3, lm.WINDOW))
    used = np.ones((3, lm.WINDOW), np.float32)
    slopes = net.gradients(ids, targets, used)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}

    def loss():
        return -np.take_along_axis(net.forward(ids)[0], targets[..., None], 2).mean()

    for name in net.p:
        at = np.unravel_index(np.abs(slopes[name]).argmax(), slopes[name].shape)
        net.p[name][at] += 1e-4
        up = loss()
        net.p[name][at] -= 2e-4
        down = loss()
        net.p[name][at] += 1e-4
        assert np.isclose((up - down) / 2e-4, slopes[name][at], rtol=2e-2)


def test_lm_query(spark, documents):
    got = query(spark, "op4_lm_scoring")
    assert len(got) == len(documents)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2) for r in got)


def test_model_learns_from_every_text(spark):
    """Each id of each text, long ones too, counts once, with the slopes of one pass over it."""
    pick = np.random.default_rng(6)
    sizes = [2, 3, lm.WINDOW, lm.WINDOW + 1, lm.WINDOW + 2, 1, 500, 30_000, 40, 40]
    texts = [pick.integers(0, 300, n) for n in sizes]
    kinds = pick.integers(0, lm.CLASSES, 300)
    rows = [(i if i < 8 else None, i, i != 3, bytearray(lm.pack_ids(t))) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id int, tag int, learn boolean, ids binary").repartition(3)
    net = lm.Attention(300)
    start = {k: v.copy() for k, v in net.p.items()}
    got = lm._slopes_of_all(frame, net, kinds)
    want = {k: np.zeros(v.shape) for k, v in net.p.items()}
    for text in texts:
        for i in range(0, len(text) - 1, lm.WINDOW):
            part = text[i : i + lm.WINDOW + 1]
            for k, slope in net.gradients(part[None, :-1], kinds[part[None, 1:]], np.ones((1, len(part) - 1))).items():
                want[k][: len(slope)] += slope * (len(part) - 1)
    assert got.pop("used")[0] == sum(n - 1 for n in sizes)
    assert all(np.allclose(got[k], want[k], rtol=1e-3, atol=1e-2) for k in want)
    assert lm.learn_from_all(net, frame, kinds) == sum(n - 1 for n in sizes) - sizes[3] + 1
    assert all((net.p[k] != start[k]).any() for k in start)


def test_packed_ids():
    ids = np.array([1, 31999, 2, 256, 0])
    assert list(lm.unpack_ids(lm.pack_ids(ids))) == list(ids)


# --- language identification


def test_language_of_held_out_documents(spark, engine):
    truth = dict(engine.execute("SELECT doc_id, lang FROM documents").fetchall())
    got = query(spark, "op5_language_id")
    held = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    right = sum(r["lang_pred"] == truth[r["doc_id"]] for r in held)
    assert right / len(held) > 0.95 and all(0 <= r["score"] <= 1 for r in got)


def test_language_of_odd_rows(edges, nothing):
    train = edges.where("doc_id in (6, 12, 13)").select(
        "doc_id", "text", F.when(F.col("doc_id") == 6, "xx").otherwise("yy").alias("lang")
    )
    book = langid.train_codebook(train)
    got = langid.identify(edges, book).collect()
    unknown = {r["doc_id"] for r in got if r["lang_pred"] == "und"}
    assert unknown >= {1, 2, 3} and not unknown & {4, 6, 12}
    assert {r["lang_pred"] for r in got if r["doc_id"] in (12, 13)} == {"yy"}
    assert langid.identify(nothing, book).collect() == []
    empty = langid.train_codebook(train.limit(0))
    assert {r["lang_pred"] for r in langid.identify(edges, empty).collect()} == {"und"}
    one = langid.train_codebook(train.where("lang = 'yy'"))
    assert {r["lang_pred"] for r in langid.identify(edges, one).collect()} == {"und", "yy"}


@pytest.mark.parametrize("k", [2, 3, 4, 5, 12, 60])
def test_codewords_differ(k):
    code = langid.codewords(k)
    gaps = [(a != b).sum() for a, b in itertools.combinations(code, 2)]
    assert min(gaps) >= (1 if k < 4 else 3)
    assert all(len(set(column)) == 2 for column in code.T)


def test_one_wrong_bit_is_corrected():
    counts = np.eye(4).repeat(8, axis=1) * 50
    book = langid.Codebook(list("abcd"), np.pad(counts, ((0, 0), (0, langid.BUCKETS - 32))))
    for language in range(4):
        for bit in range(book.code.shape[1]):
            margins = book.code[language] * 2.0
            margins[bit] *= -1
            book.margins = lambda texts, m=margins: m[None]
            assert book.decode(["x"])[0][0] == language


# --- line labels


def test_base_counts(edges, documents, spark):
    texts = [t for _, t in TEXTS] + [t for _, t in documents]
    got = np.array(lines.base_counts(texts)).T.tolist()
    assert got == [list(brute.base_counts(t)) for t in texts]


def test_line_verdicts_on_odd_rows(edges, nothing):
    got = lines.judge_lines(edges).collect()
    assert len(got) == len(TEXTS) and all(r["base_failed"] for r in got if r["doc_id"] in (1, 2, 3, 4, 12))
    assert not any(r["kept"] and r["base_failed"] for r in got)
    assert lines.judge_lines(nothing).collect() == []


def test_viterbi_finds_the_best_path():
    random = np.random.default_rng(2)
    counts = np.array([3, 1, 5, 4])
    scores, step = random.normal(size=(13, 2)), random.normal(size=(2, 2))
    got = lines.viterbi(scores, counts, step)
    at = 0
    for n in counts:
        paths = list(itertools.product((0, 1), repeat=int(n)))
        value = [
            sum(scores[at + i, p] for i, p in enumerate(path)) + sum(step[a, b] for a, b in zip(path, path[1:]))
            for path in paths
        ]
        assert tuple(got[at : at + n]) == paths[int(np.argmax(value))]
        at += n


def test_expected_counts_by_enumeration():
    random = np.random.default_rng(3)
    x = random.normal(size=(1, 4, len(lines.FEATURES)))
    scores, step = random.normal(size=(1, 4, 2)), random.normal(size=(2, 2))
    paths = list(itertools.product((0, 1), repeat=4))
    value = np.array([
        sum(scores[0, i, p] for i, p in enumerate(path)) + sum(step[a, b] for a, b in zip(path, path[1:]))
        for path in paths
    ])
    chance = np.exp(value) / np.exp(value).sum()
    pairs = np.zeros((2, 2))
    for path, c in zip(paths, chance):
        for a, b in zip(path, path[1:]):
            pairs[a, b] += c
    _, got = lines._expected(x, scores, step, np.array([4]))
    assert np.allclose(got, pairs)


def test_lines_agree_with_labels(spark, engine):
    truth = dict(engine.execute("SELECT doc_id, quality FROM labels").fetchall())
    got = [r for r in query(spark, "op9_quality_rules") if r["doc_id"] in truth and not r["base_failed"]]
    good = [r for r in got if truth[r["doc_id"]] == 1]
    bad = [r for r in got if truth[r["doc_id"]] == 0]
    assert sum(r["kept"] for r in good) / len(good) > 0.95
    assert not bad or sum(r["kept"] for r in bad) / len(bad) < 0.3


# --- quality


def test_quality_agrees_with_labels(spark, engine):
    truth = dict(engine.execute("SELECT doc_id, quality FROM labels").fetchall())
    got = [r for r in query(spark, "op1_quality") if r["doc_id"] in truth]
    good = [r["kept"] for r in got if truth[r["doc_id"]] == 1]
    bad = [r["kept"] for r in got if truth[r["doc_id"]] == 0]
    assert sum(good) / len(good) > 0.95 and sum(bad) / len(bad) < 0.4


def drawn_votes(truth, says, random):
    """Votes of labellers whose chances of (bad, good, nothing) are given per label."""
    votes = np.empty((len(truth), len(says)), np.int64)
    for i, per_label in enumerate(says):
        for label, chances in enumerate(per_label):
            own = truth == label
            votes[own, i] = random.choice(3, own.sum(), p=chances)
    return votes


def estimate(votes):
    full = np.full((len(votes), len(quality.LABELLERS)), quality.NONE)
    full[:, : votes.shape[1]] = votes
    patterns, place, counts = np.unique(
        [quality.pattern_of(v) for v in full.tolist()], return_inverse=True, return_counts=True
    )
    assert (quality.votes_of(patterns)[place] == full).all()
    good, rates = quality.expectation_maximisation(patterns, counts)
    return good[place], rates[:, : votes.shape[1]]


def test_rates_of_weak_labellers_are_recovered():
    """Labellers that are right from 55 to 95 times in a hundred, and differ between labels."""
    random = np.random.default_rng(8)
    truth = (random.random(40_000) < 0.7).astype(int)
    says = []
    for a, b in zip(np.linspace(0.55, 0.95, 11), np.linspace(0.85, 0.6, 11)):
        says.append([(0.7 * b, 0.7 * (1 - b), 0.3), (0.7 * (1 - a), 0.7 * a, 0.3)])
    good, rates = estimate(drawn_votes(truth, says, random))
    assert np.abs(rates - np.array(says).transpose(1, 0, 2)).max() < 0.03
    assert ((good > 0.5) == truth).mean() > 0.93


def test_detectors_that_only_say_bad():
    """Each finds some bad documents and hardly any good ones; silence on a document speaks for it."""
    random = np.random.default_rng(9)
    truth = (random.random(30_000) < 0.85).astype(int)
    says = [[(hit, 0, 1 - hit), (wrong, 0, 1 - wrong)] for hit, wrong in
            ((0.5, 0.01), (0.6, 0.02), (0.4, 0.005), (0.55, 0.05), (0.5, 0.03))]
    good, rates = estimate(drawn_votes(truth, says, random))
    assert np.abs(rates[:, :, 0] - np.array([[s[0][0] for s in says], [s[1][0] for s in says]])).max() < 0.05
    assert ((good > 0.5) == truth).mean() > 0.96


def test_copies_of_a_labeller_share_one_vote():
    """A weak labeller, counted six times, does not outvote three good ones."""
    random = np.random.default_rng(10)
    truth = (random.random(20_000) < 0.6).astype(int)
    chances = lambda a: [(a, 1 - a, 0), (1 - a, a, 0)]
    votes = drawn_votes(truth, [chances(0.85)] * 3 + [chances(0.6)], random)
    copies = np.hstack([votes, np.repeat(votes[:, 3:], 5, axis=1)])
    weight = np.ones(len(copies))
    assert quality.vote_shares(copies, weight).tolist() == [1, 1, 1] + [1 / 6] * 6
    good, _ = estimate(copies)
    best = ((votes[:, :3].sum(axis=1) >= 2) == truth).mean()
    assert ((good > 0.5) == truth).mean() > best - 0.01


def test_votes_are_counted_over_all_documents(spark, documents):
    frame = spark.createDataFrame(documents + [(None, None), (1, "")], "doc_id long, text string")
    got = {r["pattern"]: r["n"] for r in quality._vote_counts(frame).collect()}
    texts = [t for _, t in documents] + [None, ""]
    assert got == Counter(quality.pattern_of(quality.statistics(t)[1]) for t in texts)
    judged = {r["pattern"]: r["weak_label"] for r in quality.classify(frame).collect()}
    good, _ = quality.expectation_maximisation(sorted(got), [got[p] for p in sorted(got)])
    assert judged == pytest.approx(dict(zip(sorted(got), good.tolist())))


def test_sample_has_long_texts(spark):
    """The bound is reached from long texts, from rows without id, and beside many empty rows."""
    long = [(None, "".join(f"text {i} line {j} of it.\n" for j in range(400))) for i in range(600)]
    rows = long + [(i, " \t") for i in range(2_000)] + [(i, None) for i in range(2_000)]
    frame = spark.createDataFrame(rows, "doc_id int, text string")
    got = tables.sample_texts(frame, 60, 1_000, mark=len)
    assert len({r["text"].split()[1] for r in got}) == 60
    assert all(r["mark"] > 1_000 >= len(r["text"]) > 700 for r in got)
    seen = [int(line.split()[3]) for r in got for line in r["text"].splitlines()]
    assert min(seen) < 20 and max(seen) > 380
    everywhere = {line for _, t in long for line in t.splitlines()}
    assert all(line in everywhere for r in got for line in r["text"].splitlines())
    same = spark.createDataFrame([(1, "the same text")] * 700, "doc_id int, text string")
    assert len(tables.sample_texts(same, 60, 1_000)) == 60
    for text in ("x" * 500, "word " * 200, " " * 400 + "end", "a\n" * 300):
        assert tables.excerpt(text, 100).split() and len(tables.excerpt(text, 100)) <= 100


def test_long_documents_are_learnt_from(spark, engine, monkeypatch):
    """With a cut below every text's length the scorer still tells junk, and lines get weights."""
    monkeypatch.setattr(quality, "TRAIN_CHARS", 400)
    monkeypatch.setattr(lines, "TRAIN_CHARS", 400)
    truth = dict(engine.execute("SELECT doc_id, quality FROM labels").fetchall())
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").where("length(text) > 400")
    got = [r for r in quality.classify(docs).collect() if r["doc_id"] in truth]
    kept = [[r["kept"] for r in got if truth[r["doc_id"]] == q] for q in (0, 1)]
    assert sum(kept[0]) / len(kept[0]) < 0.6 < 0.8 < sum(kept[1]) / len(kept[1])
    weights, _ = lines.train_crf(lines.training_sample(docs))
    assert np.abs(weights).max() > 0.1


def test_quality_on_odd_rows(edges, nothing):
    got = quality.classify(edges).collect()
    assert len(got) == len(TEXTS)
    assert not any(r["kept"] or r["score"] for r in got if r["doc_id"] in (1, 2, 3))
    kept = quality.keep_good(edges)
    assert kept.columns == edges.columns
    assert kept.count() == sum(r["kept"] for r in got)
    assert quality.classify(nothing).collect() == quality.keep_good(nothing).collect() == []
