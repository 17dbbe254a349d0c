"""Loaders, sinks, run folders and the batch job."""

import os

import pytest
from conftest import rows, harbour_rows
from pyspark.errors import AnalysisException

from linkloom import load_tables, mutual_links, read_results, run_job, tables_from_catalog
from linkloom.__main__ import main
from linkloom.schemas import SCHEMAS
from linkloom.sources.sinks import write_result
from linkloom.sources.tables import quarantine_jsonl_table, read_jsonl_table, read_parquet_table
from linkloom.plans import job
from linkloom.sources.workspace import Workspace, checkpoint_root


@pytest.fixture
def stored(harbour, tmp_path):
    paths = {}
    for name, frame in harbour._asdict().items():
        paths[name] = str(tmp_path / "in" / name)
        frame.write.parquet(paths[name])
    return paths


def test_parquet_tables(spark, stored):
    tables = load_tables(spark, stored)
    assert [t.columns for t in tables] == [s.fieldNames() for s in SCHEMAS.values()]
    assert rows(mutual_links(tables)) == [(11, 13), (16, 17)]


def test_parquet_of_other_types_and_order(spark, tmp_path):
    path = str(tmp_path / "page")
    spark.sql(
        "select 'extra' as x, cast(1 as tinyint) as page_is_redirect, 0 as page_namespace,"
        " cast('Ü' as binary) as page_title, 7 as page_id"
        " union all select 'extra', cast(0 as tinyint), 0, cast('b' as binary), 8"
        " union all select 'extra', null, 0, null, 9"
    ).write.parquet(path)
    page = read_parquet_table(spark, "page", path)
    assert page.schema.simpleString() == SCHEMAS["page"].simpleString()
    assert rows(page) == [(7, "Ü", 0, True), (8, "b", 0, False), (9, None, 0, None)]


def test_json_lines(spark, tmp_path):
    lines = [
        '{"page_id": 1, "page_title": "a", "page_namespace": 0, "page_is_redirect": false}',
        '{"page_is_redirect": true, "page_title": "b", "page_id": 2, "page_namespace": 0}',
        '{"page_id": 3, "page_title": "c", "page_namespace": 1, "page_is_redirect": 1}',
        '{"page_id": 4, "page_title": null, "page_namespace": 1, "page_is_redirect": 0}',
        '{"page_id": 5}',
        "",
    ]
    path = tmp_path / "page.jsonl"
    path.write_bytes("\r\n".join(lines).encode() + b"\r\n")
    assert rows(read_jsonl_table(spark, "page", str(path))) == [
        (1, "a", 0, False),
        (2, "b", 0, True),
        (3, "c", 1, True),
        (4, None, 1, False),
        (5, None, None, None),
    ]


def test_json_that_does_not_fit_fails(spark, tmp_path):
    path = tmp_path / "redirect.jsonl"
    path.write_text('{"rd_from": "not a number", "rd_namespace": 0, "rd_title": "a"}\n')
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        read_jsonl_table(spark, "redirect", str(path)).collect()


def test_bad_json_lines_are_quarantined(spark, tmp_path):
    good = [
        '{"page_id": 1, "page_title": "a", "page_namespace": 0, "page_is_redirect": false}',
        '{"page_is_redirect": 1, "page_title": "b", "page_id": 2, "other": {"x": [1]}}',
        '{"page_id": 3, "page_title": null}',
        "",
        " ",
    ]
    bad = {
        '{"page_id": 4, "page_ti': "not a JSON object",
        "no json at all": "not a JSON object",
        '{"page_id": "four", "page_title": "d"}': "page_id is no bigint",
        '{"page_id": 5, "page_namespace": 1.5}': "page_namespace is no bigint",
        '{"page_id": 6, "page_is_redirect": "maybe"}': "page_is_redirect is no boolean",
    }
    path = tmp_path / "page.jsonl"
    path.write_bytes("\r\n".join([*good, *bad]).encode() + b"\r\n")
    found = quarantine_jsonl_table(spark, "page", str(path), str(tmp_path / "bad"))
    assert found.table.schema.simpleString() == SCHEMAS["page"].simpleString()
    assert rows(found.table) == [(1, "a", 0, False), (2, "b", None, True), (3, None, None, None)]
    stored = spark.read.parquet(str(tmp_path / "bad"))
    assert {r["text"]: r["reason"] for r in stored.collect()} == bad and found.n_bad == len(bad)
    assert all(r["file"].endswith("page.jsonl") for r in stored.collect())
    path.write_text("\n".join(good))
    clean = quarantine_jsonl_table(spark, "page", str(path), str(tmp_path / "none"))
    assert clean.n_bad == 0 and rows(clean.bad) == []
    assert rows(clean.table) == rows(read_jsonl_table(spark, "page", str(path)))


def test_quarantine_of_all_tables(spark, harbour, tmp_path):
    paths = {}
    for name, frame in harbour._asdict().items():
        paths[name] = str(tmp_path / name)
        frame.write.json(paths[name])
    with open(f"{paths['pagelinks']}/broken.json", "w") as file:
        file.write('{"pl_from": 1, "pl_fr\n')
    tables = load_tables(spark, paths, "json", quarantine=str(tmp_path / "bad"))
    assert rows(mutual_links(tables)) == [(11, 13), (16, 17)]
    assert spark.read.parquet(str(tmp_path / "bad" / "pagelinks")).count() == 1
    with pytest.raises(ValueError, match="JSON"):
        load_tables(spark, paths, quarantine=str(tmp_path / "bad"))


def test_json_tables_end_to_end(spark, harbour, tmp_path):
    paths = {}
    for name, frame in harbour._asdict().items():
        paths[name] = str(tmp_path / name)
        frame.write.json(paths[name])
    assert rows(mutual_links(load_tables(spark, paths, "json"))) == [(11, 13), (16, 17)]


def test_unknown_format(spark):
    with pytest.raises(ValueError):
        load_tables(spark, {}, "csv")


def test_catalog(spark, harbour):
    harbour.register()
    assert rows(mutual_links(tables_from_catalog(spark))) == [(11, 13), (16, 17)]
    harbour.page.createOrReplaceTempView("other_page")
    named = tables_from_catalog(spark, {"page": "other_page"})
    assert rows(named.page) == sorted(harbour_rows()["page"])
    assert rows(spark.sql("SELECT page_id FROM page WHERE page_is_redirect")) == [(12,), (14,), (15,), (18,)]


def test_sink(spark, harbour, tmp_path):
    path = str(tmp_path / "pairs")
    assert rows(write_result(mutual_links(harbour), path)) == [(11, 13), (16, 17)]
    with pytest.raises(AnalysisException):
        write_result(mutual_links(harbour), path)
    assert rows(write_result(mutual_links(harbour), path, "overwrite")) == [(11, 13), (16, 17)]


def test_checkpoint_folder_comes_from_the_session(spark, tmp_path):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert checkpoint_root(spark) == configured
    assert Workspace(spark).folder.startswith(configured + "/run-")
    assert Workspace(spark, str(tmp_path)).folder.startswith(str(tmp_path))


class Unconfigured:
    """Stands for a session without a checkpoint folder."""

    def __init__(self, master, context_dir=None):
        self.conf = self
        self.sparkContext = self
        self.master = master
        self.context_dir = context_dir

    def get(self, name, default):
        return default

    def getCheckpointDir(self):
        return self.context_dir


def test_no_local_folder_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(Unconfigured("yarn"))
    assert checkpoint_root(Unconfigured("yarn", "hdfs:///c")) == "hdfs:///c"
    assert os.path.isdir(checkpoint_root(Unconfigured("local[2]")))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(Unconfigured("local-cluster[2,1,1024]"))


def test_workspace_tables(spark, tmp_path):
    from pyspark.sql import functions as F

    work = Workspace(spark, str(tmp_path))
    stored, seen = work.store(spark.range(10), "numbers", n=F.count("*"), top=F.max("id"))
    assert seen == {"n": 10, "top": 9}
    assert stored.count() == 10 and "numbers" in stored.inputFiles()[0]
    work.store(spark.range(3), "more")
    work.drop("numbers")
    assert os.listdir(work.folder) == ["more"]
    work.drop()
    assert os.listdir(tmp_path) == []


def test_job(spark, stored, tmp_path):
    out, scratch = str(tmp_path / "out"), tmp_path / "scratch"
    result = run_job(load_tables(spark, stored), out, checkpoint_dir=str(scratch))
    for found in (result, read_results(spark, out + "/")):
        assert rows(found.mutual_links) == [(11, 13), (16, 17)]
        assert rows(found.vertices) == [(11, 11), (13, 11), (16, 16), (17, 16)]
        assert rows(found.component_stats) == [(11, 2), (16, 2)]
        assert rows(found.mutual_link_count) == [(2,)]
        assert rows(found.largest_component_vertices) == [(11, 11), (13, 11)]
        assert [r.changed for r in found.rounds] == [r.changed for r in result.rounds]
    assert os.listdir(scratch) == []


def test_job_that_cannot_end_writes_nothing(spark, stored, tmp_path, monkeypatch):
    tables, out = load_tables(spark, stored), tmp_path / "out"

    def unset(session):
        raise ValueError("set spark.checkpoint.dir")

    with monkeypatch.context() as patch:
        patch.setattr(job, "checkpoint_root", unset)
        with pytest.raises(ValueError, match="checkpoint"):
            run_job(tables, str(out))
    with pytest.raises(ValueError, match="magic"):
        run_job(tables, str(out), method="magic")
    with pytest.raises(ValueError, match="append"):
        run_job(tables, str(out), mode="append")
    with pytest.raises(ValueError, match="run id"):
        run_job(tables, str(out), run_id="../elsewhere")
    with pytest.raises(FileNotFoundError):
        read_results(spark, str(out))
    assert not out.exists()
    (out / "component_stats").mkdir(parents=True)
    with pytest.raises(FileExistsError, match="component_stats"):
        run_job(tables, str(out))
    assert os.listdir(out) == ["component_stats"]
    assert rows(run_job(tables, str(out), mode="overwrite").mutual_links) == [(11, 13), (16, 17)]


def test_command_line(spark, stored, tmp_path, capsys):
    out = str(tmp_path / "out")
    args = [f"--{name}={path}" for name, path in stored.items()]
    main([*args, f"--output={out}", "--method=min_label"])
    assert rows(read_results(spark, out).vertices) == [(11, 11), (13, 11), (16, 16), (17, 16)]
    assert "round 0: changed 2" in capsys.readouterr().out
