"""Substring deduplication by seed and extend.

Winnowing picks seeds: among the ``length - anchor + 1`` word ``anchor``-grams of every
window of ``length`` words, the one with the least hash. Equal windows have
the same seed at the same place, so every repeat of ``length`` words or more holds a
seed that both documents picked, and windows need only be compared within their seed.

1. Documents meet on seeds: one aggregate keeps, per seed, its least and
   greatest document and its least and greatest surroundings (the words that all
   windows of the seed reach, to both sides).
2. A seed in one document only is done. Where all occurrences have the same
   surroundings, the match extends as far as the seed's windows reach on both sides, and all
   of it repeats the least document.
3. Other shared seeds are extended window by window: one aggregate gives
   the least document of each window.
4. Overlapping and adjoining stretches of a document merge to its maximal repeats.

Which seeds are shared goes to the tasks as a Bloom filter of at most ``MAX_FILTER_WORDS``
64-bit words. Seeds that pass it by chance meet the exact tables, so the size
of the filter decides how many rows are shuffled, never the result. Words
and windows are compared as 64-bit hashes.
"""

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from linkloom.llm.words import flat_words, gram_hashes, hash_words, mix, slices, words
from linkloom.sources.workspace import Workspace

LENGTH = 13
ANCHOR = 5
# 32 MB, enough for about 25 million shared seeds at one false pass in a hundred.
MAX_FILTER_WORDS = 1 << 22
FILTER_BITS_PER_KEY = 12
FILTER_PROBES = 4

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def seed_runs(texts, length, anchor):
    """Stretches of windows with one seed, over all texts.

    Returns arrays (text number, first window's word position, number of windows, seed hash,
    surroundings hash) and the window hashes with the index of each run's first one.
    """
    flat, counts = flat_words(texts)
    hashes = hash_words(flat)
    ends = np.cumsum(counts)
    text_of = np.repeat(np.arange(len(counts)), counts)
    n = max(0, len(hashes) - length + 1)
    grams = gram_hashes(hashes, anchor)
    reach = length - anchor + 1
    best = grams[:n].copy()
    place = np.zeros(n, np.int64)
    for i in range(1, reach):
        other = grams[i : i + n]
        lower = other < best
        best[lower] = other[lower]
        place[lower] = i
    start = np.arange(n)
    valid = start + length <= ends[text_of[:n]]
    # The grams of a window, taken so that they cover all its words.
    whole = np.full(n, length, np.uint64)
    for i in sorted({*range(0, reach, anchor - 1 or 1), reach - 1}):
        whole = mix(whole * np.uint64(0x9E3779B97F4A7C15) + grams[i : i + n])
    at = start[valid]
    seed_place = at + place[valid]
    whole, best = whole[valid], best[valid]
    fresh = np.ones(len(at), bool)
    fresh[1:] = (seed_place[1:] != seed_place[:-1]) | (text_of[at[1:]] != text_of[at[:-1]])
    first = np.flatnonzero(fresh)
    sizes = np.diff(np.append(first, len(at)))
    # The first and the last window of a run cover all its words.
    around = mix(
        mix(whole[first] + sizes.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        + whole[first + sizes - 1]
    )
    owner = text_of[at[first]]
    position = at[first] - (ends - counts)[owner]
    return owner, position, sizes, best[first], around, whole, first


def _long(values):
    return pa.array(values.astype(np.uint64).view(np.int64))


def _seeds(docs: DataFrame, id_type: str, length: int, anchor: int) -> DataFrame:
    """(seed, doc_id, around) of every run."""

    def run(batches):
        for part in slices(batches):
            owner, _, _, seed, around, _, _ = seed_runs(
                part.column("text").to_pylist(), length, anchor
            )
            ids = part.column("doc_id").take(pa.array(owner))
            yield pa.RecordBatch.from_arrays(
                [_long(seed), ids, _long(around)], ["seed", "doc_id", "around"]
            )

    return docs.select("doc_id", "text").mapInArrow(
        run, f"seed bigint, doc_id {id_type}, around bigint"
    )


def _filter_bits(keys: DataFrame, n: int) -> np.ndarray:
    """Bloom filter over the column ``seed``; the driver gets its words, which are bounded."""
    size = 1
    while size * 64 < n * FILTER_BITS_PER_KEY and size < MAX_FILTER_WORDS:
        size *= 2
    low = F.col("seed").bitwiseAND(0xFFFFFFFF)
    high = F.shiftrightunsigned("seed", 32).bitwiseOR(1)
    spots = F.array(*((low + high * i).bitwiseAND(size * 64 - 1) for i in range(FILTER_PROBES)))
    words_set = (
        keys.select(F.explode(spots).alias("spot"))
        .groupBy(F.shiftright("spot", 6).alias("word"))
        .agg(
            F.bit_or(
                F.call_function("shiftleft", F.lit(1).cast("long"), F.col("spot").bitwiseAND(63).cast("int"))
            ).alias("bits")
        )
        .toArrow()
    )
    bits = np.zeros(size, np.uint64)
    bits[words_set["word"].to_numpy()] = words_set["bits"].to_numpy().view(np.uint64)
    return bits


def passes(bits, seeds):
    """Which seeds the filter lets through."""
    low = seeds & np.uint64(0xFFFFFFFF)
    high = seeds >> np.uint64(32) | np.uint64(1)
    found = np.ones(len(seeds), bool)
    for i in range(FILTER_PROBES):
        spot = (low + high * np.uint64(i)) & np.uint64(len(bits) * 64 - 1)
        found &= (bits[spot >> np.uint64(6)] >> (spot & np.uint64(63)) & np.uint64(1)).astype(bool)
    return found


def _stretches(docs, id_type, length, anchor, wanted, unwanted=None) -> DataFrame:
    """(seed, doc_id, tag, pos, size): runs with a seed in ``wanted`` and not in ``unwanted``."""

    def run(batches):
        for part in slices(batches):
            owner, position, sizes, seed, _, _, _ = seed_runs(
                part.column("text").to_pylist(), length, anchor
            )
            keep = passes(wanted.value, seed)
            keep[keep] = ~passes(unwanted.value, seed[keep])
            rows = pa.array(owner[keep])
            yield pa.RecordBatch.from_arrays(
                [
                    _long(seed[keep]),
                    part.column("doc_id").take(rows),
                    part.column("tag").take(rows),
                    pa.array(position[keep].astype(np.int32)),
                    pa.array(sizes[keep].astype(np.int32)),
                ],
                ["seed", "doc_id", "tag", "pos", "size"],
            )

    return docs.mapInArrow(run, f"seed bigint, doc_id {id_type}, tag bigint, pos int, size int")


def _windows(docs, id_type, length, anchor, wanted) -> DataFrame:
    """(window, doc_id, tag, pos): windows whose seed is in ``wanted``."""

    def run(batches):
        for part in slices(batches):
            owner, position, sizes, seed, _, whole, first = seed_runs(
                part.column("text").to_pylist(), length, anchor
            )
            keep = np.flatnonzero(passes(wanted.value, seed))
            each = sizes[keep]
            step = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
            rows = pa.array(np.repeat(owner[keep], each))
            yield pa.RecordBatch.from_arrays(
                [
                    _long(whole[np.repeat(first[keep], each) + step]),
                    part.column("doc_id").take(rows),
                    part.column("tag").take(rows),
                    pa.array((np.repeat(position[keep], each) + step).astype(np.int32)),
                ],
                ["window", "doc_id", "tag", "pos"],
            )

    return docs.mapInArrow(run, f"window bigint, doc_id {id_type}, tag bigint, pos int")


def repeated_stretches(
    docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR
) -> DataFrame:
    """(tag, pos, size): ``size`` consecutive windows, from word ``pos`` on, that a
    document with a smaller id has too. ``docs`` has doc_id, text and tag (a hash of both).
    """
    spark = docs.sparkSession
    work = Workspace(spark)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    known = docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text", "tag")
    met = (
        _seeds(known, id_type, length, anchor)
        .groupBy("seed")
        .agg(
            F.min("doc_id").alias("least"),
            F.max("doc_id").alias("most"),
            F.min("around").alias("around"),
            F.max("around").alias("__around"),
        )
        .where("least < most")
        .select("seed", "least", (F.col("around") == F.col("__around")).alias("same"))
    )
    shared, n = work.store(met, "shared", same=F.count_if("same"), n=F.count("*"))
    context = spark.sparkContext
    all_bits = context.broadcast(_filter_bits(shared, n["n"]))
    mixed_bits = context.broadcast(_filter_bits(shared.where(~F.col("same")), n["n"] - n["same"]))

    # Seeds that pass the filter of mixed ones by chance are extended by windows as well.
    alike = _stretches(known, id_type, length, anchor, all_bits, mixed_bits)
    first = shared.where("same").select(F.col("seed").alias("__seed"), "least")
    extended = alike.join(
        first, (F.col("seed") == F.col("__seed")) & (F.col("least") < F.col("doc_id"))
    ).select("tag", "pos", "size")

    windows = _windows(known, id_type, length, anchor, mixed_bits)
    least, _ = work.store(
        windows.groupBy("window")
        .agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
        .where("least < most")
        .select(F.col("window").alias("__window"), "least"),
        "windows",
    )
    single = windows.join(
        least, (F.col("window") == F.col("__window")) & (F.col("least") < F.col("doc_id"))
    ).select("tag", "pos", F.lit(1).alias("size"))
    return extended.unionByName(single)


def start_blocks(stretches: DataFrame) -> DataFrame:
    """(tag, blocks): the window starts of each row as bits, 64 positions to a block.

    However often a stretch comes, from equal rows or overlapping seeds, it sets its bits once.
    """
    block = F.explode(F.expr("sequence(pos div 64, (pos + size - 1) div 64)")).alias("block")
    first, end = "greatest(pos - 64 * block, 0)", "least(pos + size - 64 * block, 64)"
    bits = F.expr(
        f"shiftleft(-1L, cast({first} as int)) & shiftrightunsigned(-1L, cast(64 - {end} as int))"
    )
    return (
        stretches.select("tag", "pos", "size", block)
        .groupBy("tag", "block")
        .agg(F.bit_or(bits).alias("bits"))
        .groupBy("tag")
        .agg(F.collect_list(F.struct("block", "bits")).alias("blocks"))
    )


def covered_words(n, blocks, length):
    """Which of ``n`` words lie in a window; ``blocks`` has the (block, bits) of the windows' starts."""
    bits = np.zeros(n // 64 + 1, np.uint64)
    for block in blocks:
        # Rows whose tags collide may name places that this text does not have.
        if block["block"] < len(bits):
            bits[block["block"]] = block["bits"] % 2**64
    starts = np.flatnonzero(np.unpackbits(bits.view(np.uint8), bitorder="little")[: max(0, n - length + 1)])
    edges = np.zeros(n + 1, np.int64)
    edges[starts] += 1
    edges[starts + length] -= 1
    return np.cumsum(edges[:n]) > 0


def without(text, removed):
    """``text`` without the removed words and the white space after each of them."""
    data = text.encode()
    starts = [m.start() for m in WORD.finditer(data)]
    ends = starts[1:] + [len(data)]
    kept = [data[a:b] for a, b, out in zip(starts, ends, removed) if not out]
    return (data[: starts[0]] + b"".join(kept)).decode()


def remove_repeats(
    docs: DataFrame,
    length: int = LENGTH,
    anchor: int = ANCHOR,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry=(),
) -> DataFrame:
    """Every document without the words that repeat a document with a smaller id.

    A word goes if it lies in a window of ``length`` consecutive words that starts in
    a document with a smaller id too; windows are judged on the input. Returns id, n_words, n_removed,
    kept (the words left, joined by one space) and kept_text (the text without the
    removed words; as it was if there are none).

    NULL and empty texts have no words (kept is empty, kept_text as it was). Rows that share an id
    are no smaller than each other; each is judged by its own text. A row without id
    neither loses words nor makes others lose them. Columns named in ``carry`` come
    along as they are, others are not read.
    """
    own = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(text_col).alias("text"),
        F.xxhash64(id_col, text_col).alias("tag"),
        *(F.col(c).alias(f"carry_{i}") for i, c in enumerate(carry)),
    )
    id_type = own.schema["doc_id"].dataType.simpleString()
    found = start_blocks(repeated_stretches(own, length, anchor)).withColumnRenamed("tag", "__tag")
    extra = [c for c in own.columns if c.startswith("carry_")]
    rows = own.join(found, F.col("tag") == F.col("__tag"), "left").select(
        "doc_id", "text", "blocks", *extra
    )
    extra_types = "".join(f", {c} {rows.schema[c].dataType.simpleString()}" for c in extra)

    def run(batches):
        for part in slices(batches):
            out = []
            for text, found in zip(part.column("text").to_pylist(), part.column("blocks").to_pylist()):
                ws = words(text)
                if not found:
                    out.append((len(ws), 0, b" ".join(ws).decode(), text))
                    continue
                gone = covered_words(len(ws), found, length)
                kept = [w for w, out_ in zip(ws, gone) if not out_]
                out.append(
                    (len(ws), int(gone.sum()), b" ".join(kept).decode(), without(text, gone))
                )
            columns = list(zip(*out))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array(columns[0], pa.int64()),
                    pa.array(columns[1], pa.int64()),
                    pa.array(columns[2], pa.string()),
                    pa.array(columns[3], pa.string()),
                    *(part.column(c) for c in extra),
                ],
                ["doc_id", "n_words", "n_removed", "kept", "kept_text", *extra],
            )

    made = rows.mapInArrow(
        run,
        f"doc_id {id_type}, n_words bigint, n_removed bigint, kept string, kept_text string{extra_types}",
    )
    return made.toDF(id_col, "n_words", "n_removed", "kept", "kept_text", *carry)
