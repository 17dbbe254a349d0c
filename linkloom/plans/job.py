"""The whole batch job: link tables in, pairs, labels and statistics out.

The results are published as a whole. They are written into a folder that no reader looks at, and
become the current ones by one mark that names this folder; whoever reads them by ``read_results`` sees
all results of one job, whenever a job stops.
"""

import re
import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, types as T

from linkloom.operators import links, stats
from linkloom.plans.components import LABEL, METHODS, SIZE, Round, connected_components
from linkloom.plans.mutual import mutual_links
from linkloom.sources.sinks import write_result
from linkloom.sources.tables import LinkTables
from linkloom.sources.workspace import MarkLog, checkpoint_root, delete, exists

RESULTS = (
    "mutual_links",
    "mutual_link_count",
    "vertices",
    "component_stats",
    "largest_component_vertices",
)
SCHEMAS = {
    "mutual_links": "page_a bigint, page_b bigint",
    "mutual_link_count": "n bigint",
    "vertices": LABEL,
    "component_stats": SIZE,
    "largest_component_vertices": LABEL,
}
MODES = ("errorifexists", "overwrite")
# Versions that stay beside the current one, for readers that have opened them.
OLD_VERSIONS = 1


class JobResult(NamedTuple):
    """Frames over the written results, and the rounds the components took."""

    mutual_links: DataFrame
    mutual_link_count: DataFrame
    vertices: DataFrame
    component_stats: DataFrame
    largest_component_vertices: DataFrame
    rounds: list[Round]


def _check(spark, output: str, checkpoint_dir: str | None, method: str, mode: str) -> str:
    """Fail on whatever would stop the job later; gives the checkpoint folder."""
    if method not in METHODS:
        raise ValueError(f"unknown method {method!r}; use one of {METHODS}")
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}; use one of {MODES}")
    taken = [n for n in RESULTS if exists(spark, f"{output}/{n}")]
    if MarkLog(spark, output).numbers():
        taken.append("published results")
    if taken and mode == "errorifexists":
        raise FileExistsError(f"{', '.join(taken)} below {output}: choose another output or overwrite")
    return checkpoint_dir or checkpoint_root(spark)


def read_results(spark: SparkSession, output: str) -> JobResult:
    """The results that were published last below ``output``."""
    output = output.rstrip("/")
    found = MarkLog(spark, output).last()
    if not found:
        raise FileNotFoundError(f"no results have been published below {output}")
    state = found[1]
    frames = {
        name: spark.read.schema(SCHEMAS[name]).parquet(f"{output}/{state['version']}/{name}")
        for name in RESULTS
    }
    return JobResult(**frames, rounds=[Round(*step) for step in state["rounds"]])


def _publish(spark: SparkSession, output: str, state: dict) -> None:
    """Make a finished version the current one, then delete versions that were replaced before the last one."""
    log = MarkLog(spark, output)
    log.add(state)
    for number in log.numbers()[: -1 - OLD_VERSIONS]:
        old = log.read(number)["version"]
        log.forget(number)
        if old != state["version"]:
            delete(spark, f"{output}/{old}")


def run_job(
    tables: LinkTables,
    output: str,
    checkpoint_dir: str | None = None,
    method: str = "star",
    mode: str = "errorifexists",
    run_id: str | None = None,
) -> JobResult:
    """Write the results named in ``RESULTS`` and publish them together below ``output``.

    Each result is computed once: what builds on it reads the written table.
    Settings and output paths are checked before the first write. ``overwrite`` replaces what was published, once
    all new results are written.

    ``run_id`` names the job, and so its inputs: a call after a failure takes the results that its predecessor
    finished, goes on with the components after their last round, and publishes. Once published, the name
    is free again. Without a name a failed job deletes what it wrote.
    """
    spark = tables.page.sparkSession
    output = output.rstrip("/")
    checkpoint_dir = _check(spark, output, checkpoint_dir, method, mode)
    if run_id is not None and not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9_.-]*", run_id):
        raise ValueError(f"run id {run_id!r}: use letters, digits, '_', '.' and '-'")
    # A version never gets a name that was published before.
    serial = max(MarkLog(spark, output).numbers(), default=-1) + 1
    version = f"version-{serial}-{run_id or uuid.uuid4().hex}"

    def write(name, make):
        """The written result, of a predecessor if it got that far, else of ``make()``."""
        path = f"{output}/{version}/{name}"
        schema = T.StructType.fromDDL(SCHEMAS[name])
        if run_id is not None and exists(spark, f"{path}/_SUCCESS"):
            return spark.read.schema(schema).parquet(path)
        return write_result(make().select(*schema.fieldNames()), path, "overwrite")

    try:
        pairs = write("mutual_links", lambda: mutual_links(tables))
        count = write("mutual_link_count", lambda: links.pair_count(pairs))
        run = connected_components(
            pairs,
            method=method,
            checkpoint_dir=checkpoint_dir,
            run_id=None if run_id is None else f"{version}-components",
        )
        try:
            vertices = write("vertices", lambda: run.vertices)
            sizes = write("component_stats", lambda: run.component_stats)
            members = write(
                "largest_component_vertices", lambda: stats.members_of(vertices, run.largest)
            )
        except BaseException:
            run.workspace.release()
            raise
        _publish(spark, output, {"version": version, "rounds": run.rounds})
        run.workspace.drop()
    except BaseException:
        if run_id is None:
            delete(spark, f"{output}/{version}")
        raise
    return JobResult(
        mutual_links=pairs,
        mutual_link_count=count,
        vertices=vertices,
        component_stats=sizes,
        largest_component_vertices=members,
        rounds=run.rounds,
    )
