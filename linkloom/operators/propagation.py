"""Minimum-label propagation, one synchronous round at a time.

Edges never change, so they are stored once, bucketed by ``slot``, and only
labels and messages are shuffled in a round. A vertex's slot is its id; a vertex with more than
``limit`` edges has several slots instead, which spread its edges over buckets, and its
label is sent once to each. Once few vertices change, a round reads the buckets of their slots only.
"""

from pyspark.sql import DataFrame, functions as F

# Slots whose buckets a round picks out; with more, it reads all edges.
MOST_SLOTS = 1_000


def hot_senders(edge_list: DataFrame, limit: int) -> DataFrame:
    """(sender, salts) of the vertices with more than ``limit`` edges."""
    counted = edge_list.groupBy(F.col("src").alias("sender")).agg(F.count("*").alias("n"))
    return counted.where(F.col("n") > limit).select(
        "sender", F.ceil(F.col("n") / limit).cast("int").alias("salts")
    )


def _slot(vertex, salts, salt):
    """A hashed slot may equal another vertex's id: whoever joins on slots compares the vertices too."""
    return F.when(salts > 1, F.xxhash64(vertex, salt)).otherwise(vertex)


def salted_edges(edge_list: DataFrame, hot: DataFrame) -> DataFrame:
    """(src, dst, slot). There are at most edges / limit hot senders, a bounded broadcast."""
    found = edge_list.join(F.broadcast(hot), F.col("src") == F.col("sender"), "left")
    salts = F.coalesce("salts", F.lit(1))
    salt = F.pmod(F.xxhash64("dst"), salts).cast("int")
    return found.select("src", "dst", _slot(F.col("src"), salts, salt).alias("slot"))


def start_labels(labels: DataFrame, hot: DataFrame) -> DataFrame:
    """Labels before the first round: every vertex counts as news."""
    found = labels.join(F.broadcast(hot), F.col("vertex") == F.col("sender"), "left")
    return found.select(
        "vertex",
        "component",
        F.lit(True).alias("changed"),
        F.coalesce("salts", F.lit(1)).alias("salts"),
    )


def senders(labels: DataFrame) -> DataFrame:
    """(sender, component, slot): the vertices whose label changed, once per slot."""
    copies = labels.where("changed").select(
        F.col("vertex").alias("sender"),
        "component",
        "salts",
        F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"),
    )
    slot = _slot(F.col("sender"), F.col("salts"), F.col("salt"))
    return copies.select("sender", "component", slot.alias("told_slot"))


def reached_edges(edge_list: DataFrame, labels: DataFrame, slots: int | None) -> DataFrame:
    """The edges that a round has to read, where its senders have ``slots`` slots in all (None: unknown).

    With at most ``MOST_SLOTS``, their numbers become a filter that prunes buckets and, as buckets
    are sorted, parts of files.
    """
    if slots is None or slots > MOST_SLOTS:
        return edge_list
    few = [row[0] for row in senders(labels).select("told_slot").take(MOST_SLOTS)]
    return edge_list.where(F.col("slot").isin(few)) if few else edge_list.where("false")


def propagate(edge_list: DataFrame, labels: DataFrame) -> DataFrame:
    """One round: each vertex takes the least label among its own and its neighbours'.

    ``edge_list`` has slots. Reads only the labels of the round before. A vertex whose label did not
    change then has told its neighbours already, so only changed vertices send.
    The own label travels as ``before`` through the same aggregate, which shows
    what changed without joining new labels to old ones.
    """
    told_by = senders(labels)
    # Not an equality of its own: the join is to go by slot, as the buckets do.
    same_vertex = F.col("src").bitwiseXOR(F.col("sender")) == 0
    told = edge_list.join(told_by, (edge_list.slot == told_by.told_slot) & same_vertex).select(
        F.col("dst").alias("vertex"),
        "component",
        F.lit(None).cast("bigint").alias("before"),
        F.lit(None).cast("int").alias("salts"),
    )
    own = labels.select("vertex", "component", F.col("component").alias("before"), "salts")
    return (
        told.unionByName(own)
        .groupBy("vertex")
        .agg(
            F.min("component").alias("component"),
            F.max("before").alias("before"),
            F.max("salts").alias("salts"),
        )
        .select(
            "vertex", "component", (F.col("component") != F.col("before")).alias("changed"), "salts"
        )
    )


def changed_count(labels: DataFrame) -> DataFrame:
    """Number of vertices whose label changed in the round, as one row."""
    return labels.agg(F.count_if("changed").alias("changed"))
