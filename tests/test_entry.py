"""Every registered query against the same result from a second engine."""

import re
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as registry
import oracles
from linkloom.sources.derived import INPUTS, derived_tables

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="needs the test tables")


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    for name in INPUTS:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def test_every_query_has_its_sql():
    assert set(registry.link_queries()) == set(oracles.oracle_sql())


@pytest.mark.parametrize("name", registry.link_queries())
def test_query(spark, engine, name):
    frame = registry.link_queries()[name](spark, FOLDER)
    cursor = engine.execute(registry.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(frame.columns) == sorted(columns)
    want = sorted(map(repr, cursor.fetchall()))
    assert sorted(repr(tuple(r)) for r in frame.select(*columns).collect()) == want
    assert want


@pytest.mark.parametrize(
    "missing", ["tokenizers", "sentencepiece", "xxhash", "public_tokenizers", "linkloom.llm", "corpus_pipeline"]
)
def test_graph_queries_load_without_optional_packages(missing):
    code = (
        f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as entry; "
        "assert set(entry.queries()) == set(entry.link_queries()) == set(entry.oracle_sql())"
    )
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(registry.__file__).parent)


def test_missing_part_of_the_library_is_an_error():
    code = "import sys; sys.modules['linkloom.operators.stars'] = None; import __spark_entry__"
    done = subprocess.run(
        [sys.executable, "-c", code], cwd=Path(registry.__file__).parent, capture_output=True, text=True
    )
    assert done.returncode and "linkloom.operators.stars" in done.stderr


def test_entry(spark):
    assert registry.entry(spark).columns == ["vertex", "component"]


def test_derived_tables_exercise_the_rules(spark):
    """The made graph has redirects, red links, hot targets and repeated titles."""
    tables = derived_tables(spark, FOLDER)
    assert tables.page.where("page_is_redirect").count() > 0
    titles = tables.page.groupBy("page_title").count()
    assert titles.where("count > 1").count() > 0
    found = tables.linktarget.join(
        tables.page,
        (tables.linktarget.lt_title == tables.page.page_title)
        & (tables.linktarget.lt_namespace == tables.page.page_namespace),
        "left_anti",
    )
    assert found.count() > 0
    top = tables.pagelinks.groupBy("pl_target_id").count().orderBy("count", ascending=False)
    assert top.first()["count"] * 5 > tables.pagelinks.count()


def test_derivation_leaves_no_rows_out_by_id():
    from linkloom.sources.derived import DERIVED_SQL

    for text in DERIVED_SQL.values():
        assert "%" not in text and not re.search(r"\bLIMIT\b|key\s*[<>=]", text)
