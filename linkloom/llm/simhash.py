"""SimHash near-duplicates, found through Golay-code keys.

A 64-bit fingerprint is cut into segments of 23, 23 and 18 bits. Fingerprints
that differ in at most two bits agree in one whole segment (pigeonhole) and differ in at most two
bits in the segment after it. The perfect Golay code (23, 12, 7) puts every 23-bit
word within three bits of exactly one codeword; the codewords of a word and of
its 23 one-bit neighbours are its keys, six at most, and words that differ
in two bits share the key of the word between them. So three exact segments with
up to six keys of the next one give at most 18 keys, none of which misses a link.

Fingerprints that share a key are compared bit by bit. A key with more than
``BUCKET`` fingerprints is not joined with itself: its fingerprints are spread over their
own one-bit neighbours, which two of them share exactly if they differ in at most two bits.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from linkloom.llm.words import slices, words
from linkloom.plans.components import connected_components
from linkloom.sources.workspace import Workspace

SHINGLE = 3
MAX_BITS = 2
SEED = 42
# Most fingerprints of one key that are compared with each other.
BUCKET = 64

# (first bit, bits) of each segment.
SEGMENTS = ((0, 23), (23, 23), (46, 18))
# Fixed value: generator polynomial of the Golay code.
GENERATOR = 0b101011100011
CODE_BITS, SYNDROME_BITS = 23, 11


def bit_majority(hashes, counts):
    """64-bit number per text: bits that more than half of its hashes have.

    ``hashes`` holds the texts' hashes one after the other, ``counts`` how many each has.
    """
    result = np.zeros(len(counts), np.uint64)
    full = np.flatnonzero(counts)
    if len(full):
        starts = (np.cumsum(counts) - counts)[full]
        bits = np.unpackbits(
            hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"
        )
        sums = np.add.reduceat(bits, starts, axis=0, dtype=np.int64)
        packed = np.packbits(sums * 2 > counts[full][:, None], axis=1, bitorder="little")
        result[full] = packed.view("<u8").ravel()
    return result


def fingerprint(texts, shingle=SHINGLE):
    """SimHash of each text over its word shingles, repeats included."""
    hashes, counts = [], []
    digest = xxhash.xxh64_intdigest
    for text in texts:
        ws = words(text, lower=True)
        if len(ws) < shingle:
            grams = [b" ".join(ws)] if ws else []
        else:
            grams = map(b" ".join, zip(*(ws[i:] for i in range(shingle))))
        own = [digest(g, SEED) for g in grams]
        hashes.append(np.array(own, dtype=np.uint64))
        counts.append(len(own))
    return bit_majority(np.concatenate(hashes), np.array(counts, np.int64))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` (text and others) with ``fp`` in place of the text: 64 bits as a signed number."""
    others = [c for c in docs.columns if c != "text"]
    types = "".join(f"{c} {docs.schema[c].dataType.simpleString()}, " for c in others)

    def run(batches):
        for part in slices(batches):
            marks = fingerprint(part.column("text").to_pylist(), shingle)
            yield pa.RecordBatch.from_arrays(
                [*map(part.column, others), pa.array(marks.view(np.int64))], [*others, "fp"]
            )

    return docs.mapInArrow(run, f"{types}fp bigint")


def syndromes(values):
    """Remainder of each 23-bit word by the generator polynomial."""
    rest = values.copy()
    for bit in range(CODE_BITS - 1, SYNDROME_BITS - 1, -1):
        rest ^= np.where(rest >> bit & 1, GENERATOR << (bit - SYNDROME_BITS), 0)
    return rest


def correction_table():
    """Error pattern of at most three bits for each syndrome."""
    single = 1 << np.arange(CODE_BITS)
    pairs = single[:, None] | single[None, :]
    triples = (pairs[:, :, None] | single[None, None, :]).ravel()
    patterns = np.unique(np.concatenate([[0], single, pairs.ravel(), triples]))
    table = np.zeros(1 << SYNDROME_BITS, np.int64)
    table[syndromes(patterns)] = patterns
    return table


def codewords(values, table):
    """Index (12 bits) of the codeword within three bits of each 23-bit word."""
    return (values ^ table[syndromes(values)]) >> SYNDROME_BITS


def fingerprint_keys(marks, table):
    """(row, key) arrays: the keys of each 64-bit fingerprint, none twice."""
    parts = [
        (marks >> np.uint64(first) & np.uint64((1 << bits) - 1)).astype(np.int64)
        for first, bits in SEGMENTS
    ]
    rows, keys = [], []
    flips = np.concatenate([[0], 1 << np.arange(CODE_BITS)])
    for i in range(len(SEGMENTS)):
        after = parts[(i + 1) % len(SEGMENTS)]
        near = np.sort(codewords(after[:, None] ^ flips[None, :], table), axis=1)
        fresh = np.ones(near.shape, bool)
        fresh[:, 1:] = near[:, 1:] != near[:, :-1]
        row, column = np.nonzero(fresh)
        rows.append(row)
        keys.append(i << 36 | parts[i][row] << 12 | near[row, column])
    return np.concatenate(rows), np.concatenate(keys)


def _keyed(prints: DataFrame) -> DataFrame:
    """(key, fp) of each distinct fingerprint."""

    def run(batches):
        table = correction_table()
        for batch in batches:
            if not batch.num_rows:
                continue
            marks = batch.column("fp").to_numpy(zero_copy_only=False)
            rows, keys = fingerprint_keys(marks.view(np.uint64), table)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(marks[rows])], ["key", "fp"])

    return prints.select("fp").mapInArrow(run, "key bigint, fp bigint")


def _neighbour_links(prints: DataFrame) -> DataFrame:
    """(page_a, page_b): each fingerprint with the least one that shares a one-bit neighbour."""
    flips = F.concat(
        F.array(F.col("fp")),
        F.transform(
            F.sequence(F.lit(0), F.lit(63)),
            lambda i: F.col("fp").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i)),
        ),
    )
    spread = prints.select("fp", F.explode(flips).alias("between"))
    least = spread.groupBy("between").agg(F.min("fp").alias("least"), F.max("fp").alias("most"))
    return (
        spread.join(least.where("least < most").withColumnRenamed("between", "__b"), F.col("between") == F.col("__b"))
        .where("fp > least")
        .select(F.col("least").alias("page_a"), F.col("fp").alias("page_b"))
        .distinct()
    )


def links(prints: DataFrame, work: Workspace, bucket: int = BUCKET) -> DataFrame:
    """Pairs (page_a, page_b) of distinct fingerprints that connect all within two bits.

    ``prints`` has distinct ``fp``. Every link shows up as a pair or as a chain of pairs.
    """
    keyed, _ = work.store(_keyed(prints), "keyed")
    sizes, _ = work.store(
        keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "sizes"
    )
    shared, seen = work.store(
        keyed.join(sizes, "key"), "shared", dense=F.count_if(F.col("n") > bucket)
    )
    few = shared.where(F.col("n") <= bucket)
    apart = F.bit_count(F.col("fp").bitwiseXOR(F.col("other")))
    pairs = (
        few.select("key", "fp")
        .join(
            few.select(F.col("key").alias("__key"), F.col("fp").alias("other")),
            (F.col("key") == F.col("__key")) & (F.col("fp") < F.col("other")) & (apart <= MAX_BITS),
        )
        .select(F.col("fp").alias("page_a"), F.col("other").alias("page_b"))
        .distinct()
    )
    if not seen["dense"]:
        return pairs
    dense, _ = work.store(shared.where(F.col("n") > bucket).select("fp").distinct(), "dense")
    return pairs.unionByName(_neighbour_links(dense))


def near_duplicates(
    docs: DataFrame,
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
    bucket: int = BUCKET,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Fingerprint and group of every document: id, fp, component_id.

    Fingerprints link at ``max_bits`` (at most two) or fewer differing bits; ``component_id``
    is the least id reachable through links, the document's own included.

    NULL and empty texts have fingerprint zero and link like any other. Rows that share an id
    each get a row. A NULL id is no group's least unless all ids of the group are
    NULL. An empty table gives an empty one. Other columns are not read.
    """
    if max_bits != MAX_BITS:
        raise ValueError(f"keys and dense buckets are built for {MAX_BITS} bits")
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    found = _grouped(own, Workspace(docs.sparkSession), shingle, bucket)
    return found.select(F.col("doc_id").alias(id_col), "fp", "component_id")


def _grouped(own: DataFrame, work: Workspace, shingle: int = SHINGLE, bucket: int = BUCKET) -> DataFrame:
    """The rows of ``own`` (doc_id, text and others) with fp, component (its least fingerprint)
    and component_id in place of the text.
    """
    marked, _ = work.store(fingerprints(own, shingle), "marked")
    prints, _ = work.store(
        marked.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "prints"
    )
    run = connected_components(links(prints, work, bucket), checkpoint_dir=work.folder)
    linked = prints.join(run.vertices, F.col("fp") == F.col("vertex"), "left").select(
        "fp", "least_id", F.coalesce("component", "fp").alias("component")
    )
    linked, _ = work.store(linked, "linked")
    run.workspace.drop()
    work.drop("keyed", "sizes", "shared", "dense", "prints")
    least, _ = work.store(
        linked.groupBy("component").agg(F.min("least_id").alias("component_id")), "least"
    )
    groups, _ = work.store(
        linked.join(least, "component").select(F.col("fp").alias("__fp"), "component", "component_id"), "groups"
    )
    work.drop("linked", "least")
    return marked.join(groups, F.col("fp") == F.col("__fp")).drop("__fp")


def one_of_each(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    unique_ids: bool = True,
    shingle: int = SHINGLE,
    bucket: int = BUCKET,
) -> DataFrame:
    """One row of each group of ``docs``, with all columns.

    It is the row with the least id, and of several texts under that id the one with the least hash. A
    row without id stands for its group only if no row of the group has one. With ``unique_ids`` an
    id that stands for several groups stays once, with its least text hash; without, each group keeps its row.
    """
    work = Workspace(docs.sparkSession)
    own = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("tag")
    )
    rows = _grouped(own, work, shingle, bucket).groupBy("component", "doc_id", "tag")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "tag", "copies")
    chosen = (
        rows.agg(F.count("*").alias("copies")).groupBy("component").agg(F.min(order).alias("row")).select("row.*")
    )
    if unique_ids:
        apart = F.when(F.col("last"), F.col("tag")).alias("apart")
        chosen = chosen.groupBy("doc_id", apart).agg(F.min(F.struct("tag", "copies")).alias("row")).select(
            "doc_id", "row.*"
        )
    chosen = chosen.select(F.col("doc_id").alias("__least"), F.col("tag").alias("__tag"), "copies")
    chosen, seen = work.store(chosen, "chosen", copies=F.coalesce(F.max("copies"), F.lit(0)))
    tagged = docs.withColumn("__text_tag", F.xxhash64(text_col))
    if seen["copies"] > 1:
        tagged = tagged.dropDuplicates([id_col, "__text_tag"])
    same = F.col(id_col).eqNullSafe(F.col("__least")) & (F.col("__text_tag") == F.col("__tag"))
    return tagged.join(chosen.drop("copies"), same, "left_semi").drop("__text_tag")


def fingerprint_hex(fp):
    """A fingerprint column as 16 lowercase hex digits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
