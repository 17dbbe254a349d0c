"""Importance resampling towards a target distribution, by hashed features of one and two words.

Every feature falls into a bucket by the CRC-32 of its bytes. The log ratio of smoothed target and
source counts is the bucket's gain, a document's weight is the mean gain of its features, and documents are drawn
without replacement by the largest sums of weight and Gumbel noise. The noise comes from a hash of the
id, so the draw depends on neither order nor partitions.

Checksums are computed in bulk: the distinct features of a slice of texts are grouped by length into matrices of
bytes, whose columns update all checksums at once (``runs.crc_matrices``).
"""

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from linkloom.llm.runs import LOWERED, byte_table, crc_matrices, cut_out, find_runs, text_bytes
from linkloom.llm.words import slices
from linkloom.sources.workspace import Workspace

BUCKETS = 10_000
PERCENT = 25
MIN_WORDS = 20
SEED = 7
# Gains, weights and noise are whole thousandths.
SCALE = 1_000
SLICE_BYTES = 1 << 21
# Fixed value: rows per partition that monotonically_increasing_id counts up to.
PLACE_BITS = 33

IN_WORD = byte_table(lambda b: 48 <= b <= 57 or 97 <= b <= 122 or b >= 128)


def feature_buckets(column, buckets=BUCKETS):
    """(n_words, n_features, owner, bucket) of an Arrow column of texts.

    The first two count per text; the others have one entry per feature, in which repeats count.
    """
    data, offsets = text_bytes(column)
    data = LOWERED[data]
    starts, ends, owner = find_runs(IN_WORD[data], offsets)
    n_words = np.bincount(owner, minlength=len(column))
    found = cut_out(data, starts, ends).dictionary_encode()
    code, words = found.indices.to_numpy().astype(np.int64), found.dictionary
    follows = owner[1:] == owner[:-1]
    pair, pairs = pd.factorize((code[:-1] * max(1, len(words)) + code[1:])[follows])
    first, second = np.divmod(pairs, max(1, len(words)))
    joined = pc.binary_join_element_wise(
        words.take(pa.array(first)), words.take(pa.array(second)), pa.scalar(b" ", pa.large_binary())
    )
    bucket = np.concatenate([
        (crc_matrices(words) % np.uint32(buckets))[code],
        (crc_matrices(joined) % np.uint32(buckets))[pair],
    ])
    owner = np.concatenate([owner, owner[1:][follows]])
    return n_words, np.bincount(owner, minlength=len(column)), owner, bucket


def bucket_counts(texts: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all the texts fall into each bucket.

    Tasks send one row per bucket at most, and the sums are one row per bucket.
    """

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for part in slices(batches, limit=SLICE_BYTES):
            total += np.bincount(feature_buckets(part.column("text"), buckets)[3], minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    counted = texts.select(F.col(text_col).alias("text")).mapInArrow(run, "bucket bigint, n bigint")
    sums = counted.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, np.int64)
    out[sums["bucket"].to_numpy()] = sums["n"].to_numpy()
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log ratio of the smoothed shares of each bucket in target and source, in floored thousandths."""
    all_source, all_target = float(source.sum() + len(source)), float(target.sum() + len(target))
    return np.array(
        [
            math.floor(SCALE * math.log((t + 1.0) * all_source / ((s + 1.0) * all_target)))
            for s, t in zip(source.tolist(), target.tolist())
        ],
        np.int64,
    )


def weigh(docs: DataFrame, gains: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row of ``docs`` (doc_id, text)."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for part in slices(batches, limit=SLICE_BYTES):
            n_words, n_features, owner, bucket = feature_buckets(part.column("text"), len(gains))
            total = np.zeros(part.num_rows, np.int64)
            # Sums of integers below 2**53 are exact in doubles.
            total[:] = np.bincount(owner, gains[bucket], part.num_rows)
            columns = (n_words, n_features, total // np.maximum(1, n_features))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *(pa.array(c.astype(np.int64)) for c in columns)],
                ["doc_id", "n_words", "n_features", "weight"],
            )

    return docs.mapInArrow(
        run, f"doc_id {id_type}, n_words bigint, n_features bigint, weight bigint"
    )


def noise(doc_id, seed: int = SEED):
    """Gumbel noise from the hash of the id, in floored thousandths; a NULL id counts as empty."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long")
    return F.floor(-SCALE * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    buckets: int = BUCKETS,
    seed: int = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
) -> DataFrame:
    """Draw ``percent`` of the documents that look most like ``target``, with noise.

    Returns id, n_features, weight, score and rank for every row of ``docs``: rank counts 1, 2, 3 … by falling score
    among the floor(percent * N / 100) drawn of the N rows with at least ``min_words`` words, and is NULL for
    all others. Ties go to the smaller id, then (NULL ids last, and rows that share an id) to the row read first.

    NULL texts are empty: no feature, weight 0, never drawn. Repeated rows are drawn each on its own. With an empty
    target all gains are against a flat distribution; an empty ``docs`` gives an empty table. Other columns are
    not read. The texts are read twice, for counts and for weights, and only numbers are shuffled. Ranks come from one
    sort of all scores over as many partitions as Spark makes, numbered on from the sizes of those before.
    The result reads a stored table.
    """
    spark = docs.sparkSession
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    gains = bucket_gains(
        bucket_counts(own, "text", buckets), bucket_counts(target, target_col, buckets)
    )
    scored = (
        weigh(own, gains)
        .withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
        .withColumn("long_enough", F.col("n_words") >= min_words)
    )
    work = Workspace(spark)
    stored, seen = work.store(scored, "scored", able=F.count_if("long_enough"))
    order = [F.desc("long_enough"), F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row")]
    ordered = stored.withColumn("row", F.monotonically_increasing_id()).orderBy(*order).drop("row")
    placed, _ = work.store(ordered.withColumn("place", F.monotonically_increasing_id()), "placed")
    work.drop("scored")
    part = F.shiftright("place", PLACE_BITS)
    sizes = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).orderBy("part").collect()
    before = np.cumsum([0] + [r["n"] for r in sizes]).tolist()
    starts = spark.createDataFrame(
        [(r["part"], b) for r, b in zip(sizes, before)], "part bigint, before bigint"
    )
    rank = F.col("before") + F.col("place").bitwiseAND((1 << PLACE_BITS) - 1) + 1
    drawn = F.col("long_enough") & (rank <= percent * (seen["able"] or 0) // 100)
    # One row per partition of the sort.
    return placed.join(F.broadcast(starts), part == F.col("part")).select(
        F.col("doc_id").alias(id_col),
        "n_features",
        "weight",
        "score",
        F.when(drawn, rank).alias("rank"),
    )
