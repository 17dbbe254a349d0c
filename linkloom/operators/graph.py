"""The pair list as a graph: edges in both directions and labelled vertices."""

from pyspark.sql import DataFrame, functions as F


def edges(pairs: DataFrame) -> DataFrame:
    """Each pair as two directed edges (src, dst).

    One pass over ``pairs``; a union of two selections would run the plan
    behind them twice.
    """
    there = F.struct(F.col("page_a").alias("src"), F.col("page_b").alias("dst"))
    back = F.struct(F.col("page_b").alias("src"), F.col("page_a").alias("dst"))
    return pairs.select(F.inline(F.array(there, back)))


def vertices(edge_list: DataFrame) -> DataFrame:
    """Every vertex, labelled with itself. Edges run both ways, so src has them all."""
    return edge_list.select(F.col("src").alias("vertex")).distinct().withColumn(
        "component", F.col("vertex")
    )


def graph_counts(edge_list: DataFrame) -> DataFrame:
    """Number of directed edges and of vertices, as one row.

    Degrees are counted first, so the distinct count costs no second shuffle.
    """
    return (
        edge_list.groupBy("src")
        .agg(F.count("*").alias("degree"))
        .agg(
            F.coalesce(F.sum("degree"), F.lit(0)).cast("bigint").alias("edges"),
            F.count("*").alias("vertices"),
        )
    )
