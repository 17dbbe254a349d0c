"""What Spark makes of the queries: scans, shuffles, hot keys."""

import pathlib
import re

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from linkloom import (
    connected_components,
    load_tables,
    mutual_link_steps,
    mutual_links,
    tables_from_catalog,
)
from linkloom.operators import graph, links, propagation, redirects, stars
from linkloom.operators.selflinks import resolved_targets
from linkloom.plans.mutual import self_link_steps
from linkloom.sources.workspace import Workspace

PACKAGE = pathlib.Path(__file__).parent.parent / "linkloom"


@pytest.fixture
def stored(spark, harbour, tmp_path):
    paths = {}
    for name, frame in harbour._asdict().items():
        paths[name] = str(tmp_path / name)
        frame.write.parquet(paths[name])
    return load_tables(spark, paths)


def test_filter_and_columns_reach_the_scan(stored, conf):
    conf(adaptive__enabled="false")
    text = plan(mutual_links(stored))
    scans = re.findall(r"PushedFilters: \[(.*?)\], ReadSchema: struct<(.*?)>", text)
    link_scans = [s for s in scans if "pl_target_id" in s[1]]
    assert [s[1] for s in link_scans] == ["pl_from:bigint,pl_target_id:bigint"]
    page_scans = [s for s in scans if "page_title" in s[1]]
    assert page_scans and all("EqualTo(page_namespace,0)" in s[0] for s in page_scans)
    target_scans = [s for s in scans if "lt_title" in s[1]]
    assert target_scans and all("EqualTo(lt_namespace,0)" in s[0] for s in target_scans)
    assert all("rd_namespace" not in s[1] for s in scans)


def test_link_table_is_shuffled_once_and_pairs_once(stored, conf):
    conf(adaptive__enabled="false", autoBroadcastJoinThreshold="-1")
    resolved = redirects.resolve_targets(stored.page, stored.redirect, stored.linktarget)
    before = plan(resolved).count("Exchange hashpartitioning")
    total = plan(mutual_links(stored)).count("Exchange hashpartitioning")
    # the link table, the resolved targets, and the pairs
    assert total - before == 3
    assert "Cartesian" not in plan(mutual_links(stored))


def test_bucketed_link_table_is_not_shuffled(spark, harbour, conf):
    """A catalog table bucketed by target keeps its partitioning up to the join."""
    conf(adaptive__enabled="false", autoBroadcastJoinThreshold="-1")
    writer = harbour.pagelinks.write.mode("overwrite").bucketBy(2, "pl_target_id")
    writer.sortBy("pl_target_id").saveAsTable("bucketed_links")
    harbour.register()
    tables = tables_from_catalog(spark, {"pagelinks": "bucketed_links"})
    assert rows(mutual_links(tables)) == [(11, 13), (16, 17)]
    assert "hashpartitioning(pl_target_id" not in plan(mutual_links(tables))
    assert "hashpartitioning(pl_target_id" in plan(mutual_links(harbour))
    spark.sql("DROP TABLE bucketed_links")


def test_edges_run_the_plan_behind_the_pairs_once(stored, conf):
    conf(adaptive__enabled="false")
    assert plan(graph.edges(mutual_links(stored))).count("pl_target_id:bigint>") == 1


def test_no_python_in_the_plans(stored):
    for frame in [*mutual_link_steps(stored).values(), *self_link_steps(stored).values()]:
        assert "Python" not in plan(frame) and "InPandas" not in plan(frame)


def test_package_never_uses_volatile_checkpoints_or_cross_joins():
    for path in PACKAGE.rglob("*.py"):
        if "llm" in path.parts:
            continue
        text = path.read_text()
        for word in ("localCheckpoint", "crossJoin", ".rdd", "toPandas", ".collect()"):
            assert word not in text, (path, word)


def partitions_of(frame, condition):
    found = frame.where(condition).select(F.spark_partition_id().alias("p")).distinct()
    return found.count()


def test_unresolved_targets_do_not_meet_in_one_task(spark, conf):
    conf(adaptive__enabled="false", autoBroadcastJoinThreshold="-1", shuffle__partitions="8")
    titles = spark.range(2000).selectExpr(
        "id as lt_id", "if(id % 2 = 0, null, concat('t', id)) as lt_title_updated"
    )
    pages = spark.range(2000).selectExpr("id as page_id", "concat('t', id) as page_title")
    resolved = redirects.resolved_links(titles, pages)
    assert partitions_of(resolved, "lt_title_updated is null") == 8
    assert resolved.where("page_id = lt_id").count() == 1000
    assert resolved.where("page_id is null").count() == 1000
    older = resolved_targets(
        titles.selectExpr("lt_id", "lt_id as lt_page_id", "lt_title_updated as rd_title"), pages
    )
    assert partitions_of(older, "lt_id % 2 = 0") == 8
    assert older.where("resolved_page_id = lt_id").count() == 2000


def hot(spark, n=60_000):
    """A third of all rows share key 0."""
    return spark.range(n).selectExpr("if(id % 3 = 0, 0, id) as k", "id as v")


@pytest.fixture
def skew_shows(conf):
    """Thresholds at which the hot key above counts as skewed."""
    conf(
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        shuffle__partitions="16",
        adaptive__advisoryPartitionSizeInBytes="16k",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="64k",
        adaptive__skewJoin__skewedPartitionFactor="2",
    )


def test_hot_link_target_is_split(spark, skew_shows):
    pagelinks = hot(spark).selectExpr("v as pl_from", "k as pl_target_id")
    resolved = spark.range(60_000).selectExpr("id as lt_id", "id + 7 as page_id")
    found = links.raw_links(resolved, pagelinks)
    for frame in (found, links.mutual_from_links(found), links.page_links(resolved, pagelinks)):
        frame.collect()
        assert "skew=true" in plan(frame)
    assert found.count() == 60_000


def test_salts_spread_hot_targets_without_adaptive_execution(spark, conf, tmp_path):
    """A third of all links go to one target, a tenth to another; no task gets over twice the median."""
    conf(
        adaptive__enabled="false", autoBroadcastJoinThreshold="-1", shuffle__partitions="16"
    )
    target = "if(id % 3 = 0, 0, if(id % 10 = 1, 1, id))"
    spark.range(90_000).selectExpr("id as pl_from", f"{target} as pl_target_id").write.parquet(str(tmp_path / "l"))
    pagelinks = spark.read.parquet(str(tmp_path / "l"))
    resolved = spark.range(90_000).selectExpr("id as lt_id", "id + 7 as page_id")
    resolved = resolved.unionByName(spark.sql("SELECT 0L AS lt_id, 5L AS page_id"))
    heavy = {r["hot_target"]: r["salts"] for r in links.hot_targets(pagelinks).collect()}
    assert set(heavy) == {0, 1} and 60 <= heavy[0] <= 75 and 10 <= heavy[1] <= 20
    found = links.raw_links_salted(resolved, pagelinks)
    sizes = sorted(r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect())
    assert len(sizes) == 16 and sizes[-1] <= 2 * sizes[8]
    plain = links.raw_links(resolved, pagelinks)
    before = [r["count"] for r in plain.groupBy(F.spark_partition_id()).count().collect()]
    assert max(before) > 4 * sorted(before)[len(before) // 2]
    assert found.exceptAll(plain).count() == plain.exceptAll(found).count() == 0


def test_salts_on_small_and_empty_tables(spark, harbour):
    assert rows(mutual_links(harbour, hot_targets="salted")) == [(11, 13), (16, 17)]
    empty = harbour._replace(pagelinks=harbour.pagelinks.limit(0))
    assert rows(mutual_links(empty, hot_targets="salted")) == []
    unknown = harbour._replace(pagelinks=harbour.pagelinks.selectExpr("pl_from", "pl_from_namespace", "cast(null as bigint) pl_target_id"))
    assert rows(mutual_links(unknown, hot_targets="salted")) == []
    with pytest.raises(ValueError, match="unknown way"):
        mutual_links(harbour, hot_targets="hope")


@pytest.mark.parametrize("short", [True, False])
def test_hot_redirect_title_is_split(spark, skew_shows, conf, tmp_path, short):
    """A third of all pages redirect to one title.

    A partition is split between the tasks that wrote it, so the small stages
    before must not shrink to one task.
    """
    conf(adaptive__coalescePartitions__enabled="false")
    title = "concat('t', id)"
    given = {
        "page": ["id as page_id", f"{title} as page_title", "0L as page_namespace",
                 "id > 0 as page_is_redirect"],
        "redirect": ["id as rd_from", "concat('t', if(id % 3 = 0, 0, id)) as rd_title"],
        "linktarget": ["id as lt_id", f"{title} as lt_title", "0L as lt_namespace"],
    }
    frames = {}
    for name, columns in given.items():
        spark.range(60_000).selectExpr(*columns).write.parquet(str(tmp_path / name))
        frames[name] = spark.read.parquet(str(tmp_path / name))
    if short:
        resolved = redirects.resolve_targets(**frames)
    else:
        pages = redirects.main_pages(frames["page"])
        redirected = redirects.page_redirects(pages, frames["redirect"])
        targets = redirects.link_targets(redirected, frames["linktarget"])
        resolved = redirects.resolved_links(redirects.effective_titles(targets), pages)
    found = resolved.collect()
    assert len(found) == 60_000
    assert sum(r["page_id"] == 0 for r in found) == 20_000
    assert "skew=true" in plan(resolved)


def test_round_shuffles_labels_and_not_edges(spark, conf, tmp_path):
    """Edges are read from their buckets; a hot sender's lie in many, its label goes to each."""
    conf(
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__enabled="false",
        shuffle__partitions="16",
    )
    edge_list = hot(spark).selectExpr("k as src", "v as dst")
    senders = propagation.hot_senders(edge_list, 1000)
    assert rows(senders) == [(0, 20)]
    work = Workspace(spark, str(tmp_path))
    salted = work.store_bucketed(
        propagation.salted_edges(edge_list, senders), "edges", "slot"
    )
    given = spark.range(60_000).selectExpr("id as vertex", "id as component")
    labels, _ = work.store(propagation.start_labels(given, senders), "labels")
    after = propagation.propagate(salted, labels)
    text = plan(after)
    assert "hashpartitioning(src" not in text and "hashpartitioning(slot" not in text
    assert text.count("Exchange hashpartitioning") == 2
    assert "hashpartitioning(told_slot" in text and "hashpartitioning(vertex" in text
    sizes = [
        r["count"]
        for r in salted.where("src = 0").groupBy(F.input_file_name()).count().collect()
    ]
    assert len(sizes) >= 10 and max(sizes) < 6000
    assert len(after.collect()) == 60_000
    work.drop()


@pytest.mark.parametrize("step", [stars.large_star, stars.small_star])
@pytest.mark.parametrize("centre", ["hi", "lo"])
def test_hot_vertex_rows_are_spread(spark, conf, step, centre, monkeypatch, tmp_path):
    """Rows of a hot vertex reach the lookup join in every partition, not in one."""
    conf(adaptive__enabled="false", autoBroadcastJoinThreshold="-1", shuffle__partitions="8")
    n = 4000
    if centre == "hi":
        edge_rows = spark.range(n).selectExpr(f"{n}L as hi", "id as lo")
    else:
        edge_rows = spark.range(1, n).selectExpr("id as hi", "0L as lo")
    edge_rows = edge_rows.withColumn("moved", F.lit(False))
    edge_rows.write.parquet(str(tmp_path / "edges"))
    edge_rows = spark.read.parquet(str(tmp_path / "edges"))
    seen = {}
    look_up = stars._look_up

    def watched(frame, *args):
        seen["joined"] = look_up(frame, *args)
        return seen["joined"]

    monkeypatch.setattr(stars, "_look_up", watched)
    result = step(edge_rows, 100)
    # The largest looked-up value keeps the join in the plan.
    placed = seen["joined"].groupBy(F.spark_partition_id())
    sizes = [r["n"] for r in placed.agg(F.count("*").alias("n"), F.max("least")).collect()]
    assert len(sizes) == 8 and max(sizes) < n / 4
    assert rows(result) == rows(step(edge_rows))
    assert plan(result).count("BroadcastExchange") == 1


def operators(text):
    return re.findall(r"^[ +:\-*(0-9)]*([A-Z]\w+)", text, re.MULTILINE)


def test_star_steps_have_one_plan_for_all_sizes(spark, conf, tmp_path):
    """Ten edges, and more than the hot limit with a vertex above it."""
    conf(adaptive__enabled="false", autoBroadcastJoinThreshold="-1")
    found = []
    for n in (10, 3000):
        folder = str(tmp_path / str(n))
        spark.range(n).selectExpr(f"{n}L as hi", "id as lo", "false as moved").write.parquet(folder)
        edge_rows = spark.read.parquet(folder)
        limit = stars.hot_limit(n, 100)
        steps = stars.large_star(edge_rows, limit), stars.small_star(edge_rows, limit)
        found.append([operators(plan(step)) for step in steps])
    assert found[0] == found[1]
    assert all("Window" not in step for step in found[0])


def test_labels_are_stored_once(spark, conf):
    conf(adaptive__enabled="false")
    pairs = spark.range(30).selectExpr("id as page_a", "id + 1 as page_b")
    for method in ("star", "min_label"):
        run = connected_components(pairs, method=method)
        text = plan(run.largest_component_vertices)
        assert "Union" not in text and "Generate" not in text
        assert text.count("FileScan") == 1 and "EqualTo(component,0)" in text
        assert all("/labels" in f for f in run.vertices.inputFiles())
        text = plan(run.component_stats)
        assert text.count("FileScan") == 1 and "Exchange" not in text
        assert all("/sizes/" in f for f in run.component_stats.inputFiles())


def test_one_aggregate_gives_sizes_and_labels(spark, conf):
    """Labels of finished stars are written from their rows and sizes without another shuffle."""
    conf(adaptive__enabled="false")
    star_rows = spark.range(1, 50).selectExpr("id as hi", "id % 3 as lo").where("hi > 2")
    sizes = stars.star_sizes(star_rows)
    assert plan(sizes).count("Exchange") == 1
    stored = spark.createDataFrame(sizes.collect(), sizes.schema)
    labels = stars.star_labels(star_rows, stored)
    assert "Exchange" not in plan(labels)
    assert sorted(labels.groupBy("component").count().collect()) == sorted(stored.collect())


def test_late_rounds_read_few_edge_buckets(spark, conf, tmp_path):
    """The edges of the vertices that changed decide what a round reads, hot ones included."""
    conf(adaptive__enabled="false", shuffle__partitions="32", autoBroadcastJoinThreshold="-1")
    edge_list = hot(spark, 20_000).selectExpr("k as src", "v as dst")
    senders = propagation.hot_senders(edge_list, 2000)
    work = Workspace(spark, str(tmp_path))
    salted = work.store_bucketed(propagation.salted_edges(edge_list, senders), "edges", "slot")
    given = spark.range(20_000).selectExpr("id as vertex", "id as component")
    for changed, most in (("vertex = 17", 1), ("vertex IN (1, 5, 7)", 3), ("vertex = 0", 4), ("false", 0)):
        labels = propagation.start_labels(given, senders).withColumn("changed", F.expr(changed))
        stored, seen = work.store(
            labels, f"labels-{abs(hash(changed))}", slots=F.sum(F.when(F.col("changed"), F.col("salts")))
        )
        edges = propagation.reached_edges(salted, stored, seen["slots"] or 0)
        found = propagation.propagate(edges, stored)
        assert rows(found, "vertex", "component") == rows(propagation.propagate(salted, stored), "vertex", "component")
        text = plan(found)
        assert "hashpartitioning(slot" not in text
        read = re.search(r"SelectedBucketsCount: (\d+) out of 32", text)
        assert int(read[1]) <= most if most else read is None and "salted" not in text
    labels = propagation.start_labels(given, senders)
    assert propagation.reached_edges(salted, labels, propagation.MOST_SLOTS + 1) is salted
    assert propagation.reached_edges(salted, labels, None) is salted
    work.drop()


def test_titles_are_shuffled_once_and_only_as_keys(stored, conf):
    """Every table's titles move once, pages once more to be looked up; all other shuffles are of numbers."""
    conf(adaptive__enabled="false", autoBroadcastJoinThreshold="-1")
    text = plan(redirects.resolve_targets(stored.page, stored.redirect, stored.linktarget))
    moved = re.findall(r"Exchange hashpartitioning\((\w+)#\d+", text)
    assert moved.count("leads_to") == 1 and moved.count("found_title") <= 2
    assert moved.count("lt_title") <= 2 and moved.count("page_title") == 2
    assert sorted(set(moved)) == ["found_title", "leads_to", "lt_title", "own_id", "page_title", "rd_from"]
    # The side that was joined on titles goes on with ids alone.
    for key in ("own_id", "rd_from"):
        at = text.index(f"hashpartitioning({key}")
        below = text[at : at + 600]
        assert re.search(r"Project \[[^\]]*\]", below) and "title" not in re.search(r"Project \[([^\]]*)\]", below)[1]


def test_rounds_leave_no_lineage(spark):
    pairs = spark.range(30).selectExpr("id as page_a", "id + 1 as page_b")
    for method in ("star", "min_label"):
        labels = connected_components(pairs, method=method).vertices
        text = labels._jdf.queryExecution().optimizedPlan().toString()
        assert len(text.splitlines()) <= 12 and "Join" not in text
        assert all("/run-" in f for f in labels.inputFiles())
