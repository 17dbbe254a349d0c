"""Connected components of a pair list: a driver loop over Spark jobs.

The driver only sees counts. Each round is one job whose result is written as a
table under the shared checkpoint folder and read back, so plans stay short and
a lost executor never costs more than the round at work. A named run also marks each
round, so a lost driver does not cost more either: the next call under that name goes on from the last mark.
"""

import time
from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from linkloom.operators import graph, propagation, stars, stats
from linkloom.sources.workspace import Workspace

METHODS = ("star", "min_label")

EDGE = "hi bigint, lo bigint"
STAR_EDGE = f"{EDGE}, moved boolean"
SALTED = "src bigint, dst bigint, slot bigint"
LABEL = "vertex bigint, component bigint"
STATE_LABEL = f"{LABEL}, changed boolean, salts int"
SIZE = "component bigint, size bigint"


class Round(NamedTuple):
    """What one round did.

    ``changed`` counts vertices (min_label) or edges that moved (star), ``rows`` what it worked on: the slots of
    the vertices that sent their label, or the edges of unsettled components.
    """

    round: int
    changed: int
    seconds: float
    rows: int


class Components(NamedTuple):
    """Labels, sizes and the course of a run.

    Labels and sizes are stored tables in ``workspace``, its only ones; drop it when done. ``largest`` is the label
    of the largest component (the smaller one on ties), None for an empty graph.
    """

    vertices: DataFrame
    component_stats: DataFrame
    largest: int | None
    rounds: list[Round]
    workspace: Workspace

    @property
    def largest_component_vertices(self) -> DataFrame:
        return stats.members_of(self.vertices, self.largest)

    def round_metrics(self) -> DataFrame:
        """(round, changed, seconds), one row per round."""
        return self.workspace.spark.createDataFrame(
            [step[:3] for step in self.rounds], "round bigint, changed bigint, seconds double"
        )


def connected_components(
    pairs: DataFrame,
    method: str = "star",
    checkpoint_dir: str | None = None,
    max_rounds: int | None = None,
    hot_rows: int = stars.HOT_ROWS,
    run_id: str | None = None,
) -> Components:
    """Label every page in ``pairs`` (page_a, page_b) with the least page id it can reach.

    ``star`` needs a number of rounds that grows with the logarithm of the graph,
    ``min_label`` one that grows with the longest shortest path; the labels are
    the same. Pairs may repeat, run either way or join a page to itself; a pair
    with an unknown end is no edge.

    ``max_rounds`` fails the run when passed, as labels would be wrong then.
    ``hot_rows`` is the number of edges from which a vertex is treated apart: what one task
    takes with ease. Each round is written as a table.

    ``run_id`` names the run, and so its pairs and options: after a failure a call with the same name
    goes on after the last round that was marked, without reading ``pairs`` again, and after success it returns the stored
    labels. What another method or limit has begun is refused.
    """
    if method not in METHODS:
        raise ValueError(f"unknown method {method!r}; use one of {METHODS}")
    work = Workspace(pairs.sparkSession, checkpoint_dir, run_id)
    start, advance, finish = _STAGES[method]
    options = {"method": method, "hot_rows": hot_rows}
    try:
        state = work.recover()
        if state and state["options"] != options:
            raise ValueError(f"run {run_id!r} was begun with {state['options']}")
        if not state:
            state = {"options": options, "rounds": [], "done": False} | start(pairs, work, hot_rows)
            work.mark(state)
        while state["changed"]:
            if max_rounds is not None and len(state["rounds"]) >= max_rounds:
                raise RuntimeError(f"components not settled after {len(state['rounds'])} rounds")
            state = _one_round(state, work, advance)
        if not state["done"]:
            state |= finish(state, work) | {"done": True}
            work.mark(state)
    except BaseException:
        work.release()
        raise
    rounds = [Round(*step) for step in state["rounds"]]
    labels, sizes = work.table(LABEL, state["labels"]), work.table(SIZE, "sizes")
    return Components(labels, sizes, state["largest"], rounds, work)


def _one_round(state: dict, work: Workspace, advance) -> dict:
    started, number = time.monotonic(), len(state["rounds"])
    after = advance(state, work, number)
    step = Round(number, after["changed"], time.monotonic() - started, state["rows"])
    state = state | after | {"rounds": [*state["rounds"], step]}
    work.mark(state)
    return state


def _with_largest(sizes: DataFrame, work: Workspace) -> dict:
    """Store component sizes, and note the largest as they pass. ``~`` turns the order of labels round."""
    best = F.max(F.struct("size", F.bitwise_not("component").alias("turned")))
    _, seen = work.store(sizes.select("component", "size"), "sizes", best=best)
    return {"largest": ~seen["best"]["turned"] if seen["best"] else None}


# --- stars


def _start_stars(pairs: DataFrame, work: Workspace, hot_rows: int) -> dict:
    hi, lo = F.col("hi"), F.col("lo")
    _, seen = work.store(
        stars.pair_edges(pairs).withColumn("moved", F.lit(True)),
        "edges-0",
        edges=F.count_if(hi != lo),
        loops=F.count_if(hi == lo),
    )
    return {
        "edges": "edges-0",
        "rows": seen["edges"],
        "changed": seen["edges"],
        "loops": seen["loops"],
        "settled": [],
        "tables": ["edges-0"],
    }


def _star_round(state: dict, work: Workspace, number: int) -> dict:
    """Large star, from which settled rows are set apart, then small star on the others."""
    limit = stars.hot_limit(state["rows"], state["options"]["hot_rows"])
    rows = work.table(STAR_EDGE, state["edges"]).where("hi != lo")
    spread, seen = work.store(
        stars.large_star(rows, limit),
        f"spread-{number}",
        partition_by="settled",
        settled=F.count_if("settled"),
    )
    after = f"edges-{number + 1}"
    _, found = work.store(
        stars.small_star(spread.where("NOT settled").drop("settled"), limit),
        after,
        edges=F.count("*"),
        moved=F.count_if("moved"),
    )
    settled = state["settled"] + [f"spread-{number}/settled=true"] * (seen["settled"] > 0)
    loops = ["edges-0"] * (state["loops"] > 0)
    return {
        "edges": after,
        "rows": found["edges"],
        "changed": found["moved"],
        "settled": settled,
        "tables": [after, *settled, *loops],
    }


def _finish_stars(state: dict, work: Workspace) -> dict:
    """Sizes from one aggregate over the stars' rows; the labels are then written without a shuffle."""
    # Before the first round, edges-0 holds loops at most.
    rounds_done = [state["edges"]] if state["rounds"] else []
    parts = rounds_done + state["settled"]
    spark = work.spark
    rows = work.table(EDGE, *parts) if parts else spark.createDataFrame([], EDGE)
    lone = None
    if state["loops"]:
        loops = work.table(EDGE, "edges-0").where("hi = lo")
        lone, _ = work.store(stars.lone_vertices(loops, rows), "lone")
    largest = _with_largest(stars.star_sizes(rows, lone), work)
    work.store(stars.star_labels(rows, work.table(SIZE, "sizes")), "labels")
    return largest | {"labels": "labels", "tables": ["labels", "sizes"]}


# --- minimum labels


def _start_labels(pairs: DataFrame, work: Workspace, hot_rows: int) -> dict:
    known = pairs.where(F.col("page_a").isNotNull() & F.col("page_b").isNotNull())
    edge_list, first = work.store(graph.edges(known), "edges", n=F.count("*"))
    limit = stars.hot_limit(first["n"], hot_rows)
    hot, _ = work.store(propagation.hot_senders(edge_list, max(1, limit)), "hot")
    salted = work.store_bucketed(propagation.salted_edges(edge_list, hot), "salted", "slot")
    _, seen = work.store(
        propagation.start_labels(graph.vertices(edge_list), hot),
        "labels-0",
        n=F.count("*"),
        slots=F.sum("salts"),
    )
    buckets = int(work.spark.conf.get("spark.sql.shuffle.partitions"))
    return {
        "now": "labels-0",
        "changed": seen["n"],
        "rows": seen["slots"] or 0,
        "buckets": buckets,
        "tables": ["labels-0", "salted"],
    }


def _label_round(state: dict, work: Workspace, number: int) -> dict:
    labels = work.table(STATE_LABEL, state["now"])
    salted = work.reopen_bucketed("salted", SALTED, state["buckets"], "slot")
    edges = propagation.reached_edges(salted, labels, state["rows"])
    after = f"labels-{number + 1}"
    _, seen = work.store(
        propagation.propagate(edges, labels),
        after,
        changed=F.count_if("changed"),
        slots=F.sum(F.when(F.col("changed"), F.col("salts"))),
    )
    return {
        "now": after,
        "changed": seen["changed"],
        "rows": seen["slots"] or 0,
        "tables": [after, "salted"],
    }


def _finish_labels(state: dict, work: Workspace) -> dict:
    now = state["now"]
    largest = _with_largest(stats.component_stats(work.table(LABEL, now)), work)
    return largest | {"labels": now, "tables": [now, "sizes"]}


_STAGES = {
    "star": (_start_stars, _star_round, _finish_stars),
    "min_label": (_start_labels, _label_round, _finish_labels),
}
