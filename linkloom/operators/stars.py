"""Large-star and small-star: edge rewriting that ends in one star per component.

After Kiveris, Lattanzi, Mirrokni, Rastogi and Vassilvitskii, "Connected
Components in MapReduce and Beyond", SoCC 2014. An edge is one row (hi, lo)
with hi > lo, so a vertex's least neighbour is the least ``lo`` among its rows
as ``hi``: larger neighbours cannot lower it. Neither step adds rows, and both
keep every component connected.

Vertices with many edges. The lookups below are joins on one end of an edge,
and a single vertex may hold a large share of all rows there. Keys with more
than ``hot_limit`` rows are looked up by broadcast and their rows are spread
over the shuffle by the other end. There are at most rows / hot_limit such
keys, which bounds the broadcast. Graphs of any size take the same plan; without
such keys the broadcast is empty.

Both steps say of every row whether it moved. A round in which none did has
left stars only.

Settled stars. Call a vertex touched if it is an end of a row that moved in the round before. A row whose ``lo`` is
not touched belongs to a star that is finished and is its whole component: rows of ``lo`` as ``hi``, rows of
``hi`` as ``lo``, and further rows of ``hi`` would each have moved, in the large or the small step, and
brought a moved row to ``lo``. The large step marks such rows as settled, with the lookup that it makes
anyway, and they need not take part any more.
"""

from pyspark.sql import DataFrame, functions as F

HOT_ROWS = 1_000_000
MAX_HOT_KEYS = 1_000_000


def hot_limit(rows: int, hot_rows: int = HOT_ROWS) -> int:
    """Rows from which a key counts as hot: at most MAX_HOT_KEYS keys exceed it."""
    return max(hot_rows, rows // MAX_HOT_KEYS)


def pair_edges(pairs: DataFrame) -> DataFrame:
    """Rows (hi, lo) of unordered pairs, self pairs included; unknown ends drop out."""
    a, b = F.col("page_a"), F.col("page_b")
    return pairs.where(a.isNotNull() & b.isNotNull()).select(
        F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")
    )


def _look_up(rows: DataFrame, key: str, other: str, table: DataFrame, limit: int) -> DataFrame:
    """``rows`` with ``least`` from ``table`` (vertex, least, load, useful), and whether they are ``listed``.

    ``least`` is NULL, and ``listed`` false, without an entry, or where the entry is not ``useful``.
    """
    return rows.sparkSession.sql(
        f"""
        SELECT /*+ BROADCAST(hot) */ e.*, coalesce(hot.least, rest.least) AS least,
          coalesce(hot.useful, rest.vertex IS NOT NULL) AS listed
        FROM {{rows}} e
        LEFT JOIN (SELECT * FROM {{table}} WHERE load > {int(limit)}) hot ON e.{key} = hot.vertex
        LEFT JOIN (SELECT * FROM {{table}} WHERE load <= {int(limit)} AND useful) rest
          ON rest.vertex = CASE WHEN hot.vertex IS NULL THEN e.{key} ELSE e.{other} END
          AND hot.vertex IS NULL
        """,
        rows=rows,
        table=table,
    )


def large_star(edge_rows: DataFrame, limit: int = HOT_ROWS) -> DataFrame:
    """Re-attach the larger end of every edge to the least neighbour of its smaller end.

    Rows (hi, lo, moved, settled); they may repeat. ``limit`` is the hot-key limit. Where ``edge_rows`` say
    which of them ``moved`` in the round before, settled rows are told from the others.
    """
    if "moved" not in edge_rows.columns:
        edge_rows = edge_rows.withColumn("moved", F.lit(True))
    # One row per end: the larger end learns its least neighbour, the smaller one how many rows it has.
    table = edge_rows.sparkSession.sql(
        """
        SELECT vertex, least, load, least IS NOT NULL OR touched AS useful
        FROM (
          SELECT vertex, min(below) AS least, sum(row) AS load, max(moved) AS touched
          FROM (
            SELECT moved, inline(array(
              named_struct('vertex', hi, 'below', lo, 'row', 0),
              named_struct('vertex', lo, 'below', CAST(NULL AS BIGINT), 'row', 1)))
            FROM {rows}
          )
          GROUP BY vertex
        )
        WHERE load > 0
        """,
        rows=edge_rows,
    )
    return _look_up(edge_rows, "lo", "hi", table, limit).selectExpr(
        "hi", "coalesce(least, lo) AS lo", "least IS NOT NULL AS moved", "NOT listed AS settled"
    )


def small_star(edge_rows: DataFrame, limit: int = HOT_ROWS) -> DataFrame:
    """Attach every vertex, and its smaller neighbours, to the least of these.

    The row that holds a vertex's least neighbour stays, every other row moves
    down to join that neighbour and the one it held. Rows (hi, lo, moved) without
    repeats; ``moved`` includes the moves that ``edge_rows`` tell of. They are read
    twice: store them.
    """
    # A vertex with one row has no second neighbour to move.
    table = edge_rows.sparkSession.sql(
        """
        SELECT hi AS vertex, min(lo) AS least, count(*) AS load, count(*) > 1 AS useful
        FROM {rows} GROUP BY hi
        """,
        rows=edge_rows,
    )
    found = _look_up(edge_rows, "hi", "lo", table, limit)
    return found.sparkSession.sql(
        """
        SELECT hi, lo, max(moved) AS moved
        FROM (
          SELECT if(moves, lo, hi) AS hi, if(moves, least, lo) AS lo, moved OR moves AS moved
          FROM (SELECT hi, lo, least, moved, coalesce(lo > least, false) AS moves FROM {found})
        )
        GROUP BY hi, lo
        """,
        found=found,
    )


def star_sizes(edge_rows: DataFrame, lone: DataFrame | None = None) -> DataFrame:
    """(component, size) from the finished stars, in one aggregate over their rows.

    ``lone`` (vertex) has the vertices that are in no star.
    """
    sizes = edge_rows.groupBy(F.col("lo").alias("component")).agg((F.count("*") + 1).alias("size"))
    if lone is None:
        return sizes
    return sizes.unionByName(lone.select(F.col("vertex").alias("component"), F.lit(1).cast("bigint").alias("size")))


def lone_vertices(self_pairs: DataFrame, edge_rows: DataFrame) -> DataFrame:
    """Vertices with a pair of their own and no place in any finished star."""
    leaf, centre = F.col("hi").alias("vertex"), F.col("lo").alias("vertex")
    placed = edge_rows.select(leaf).unionByName(edge_rows.select(centre).distinct())
    return self_pairs.select(leaf).distinct().join(placed, "vertex", "left_anti")


def star_labels(edge_rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """(vertex, component) from the finished stars and their ``star_sizes``.

    Each leaf has one row, and each component one size, whose label is its centre: nothing is shuffled.
    """
    leaves = edge_rows.select(F.col("hi").alias("vertex"), F.col("lo").alias("component"))
    return leaves.unionByName(sizes.select(F.col("component").alias("vertex"), "component"))
