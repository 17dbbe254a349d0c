"""Component statistics. Every order has a tie-break, so results are stable."""

from pyspark.sql import DataFrame, functions as F

# Width of the id range that one row of component_members covers, and so the
# most members that it can hold.
MEMBER_BLOCK = 1000


def component_stats(labels: DataFrame) -> DataFrame:
    """Number of vertices per component."""
    return labels.groupBy("component").agg(F.count("*").alias("size"))


def top_components(stats: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` largest components; the smaller label wins a tie."""
    return stats.orderBy(F.desc("size"), F.asc("component")).limit(k)


def members_of(labels: DataFrame, component: int | None) -> DataFrame:
    """Vertices of one component, by a filter that reaches the scan; none for None."""
    return labels.where(F.col("component") == F.lit(component).cast("bigint")).select(
        "vertex", "component"
    )


def first_members(members: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` members with the smallest ids."""
    return members.orderBy("vertex").limit(k)


def _block_number(block: int):
    """Number of the id block of a vertex; rounds down, for negative ids too."""
    return F.expr(f"(vertex - pmod(vertex, {int(block)})) div {int(block)}")


def component_members(labels: DataFrame, block: int = MEMBER_BLOCK) -> DataFrame:
    """Sorted members per component, in rows of bounded size.

    A component may hold most of the graph, too much for one row or task.
    Members are therefore listed per (component, id block): ids are unique, so
    a row holds at most ``block`` of them. All rows of a component together
    are its whole member set.
    """
    return (
        labels.groupBy("component", _block_number(block).alias("id_block"))
        .agg(F.array_sort(F.collect_list("vertex")).alias("members"))
        .select("component", "id_block", "members")
    )
