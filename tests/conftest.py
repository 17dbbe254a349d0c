import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from linkloom.schemas import SCHEMAS  # noqa: E402
from linkloom.sources.tables import LinkTables  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[4]")
        .appName("linkloom-tests")
        .config("spark.sql.shuffle.partitions", "2")
        .config("spark.default.parallelism", "2")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set SQL options for one test."""
    before = {}

    def set_all(**options):
        for name, value in options.items():
            name = "spark.sql." + name.replace("__", ".")
            before.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield set_all
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.fixture
def link_tables(spark):
    """Build the four tables from lists of tuples."""

    def build(page=(), redirect=(), linktarget=(), pagelinks=()):
        given = {
            "page": page,
            "redirect": redirect,
            "linktarget": linktarget,
            "pagelinks": pagelinks,
        }
        return LinkTables(
            **{name: spark.createDataFrame(list(given[name]), SCHEMAS[name]) for name in SCHEMAS}
        )

    return build


def harbour_rows():
    """A small wiki: flagged pages, a chain of redirects, an unflagged page with a redirect
    row, redirects to nowhere, a link target without a page, and a link to oneself.
    """
    return {
        "page": [
            (11, "Harbour", 0, False),
            (12, "Port", 0, True),
            (13, "Lighthouse", 0, False),
            (14, "Pharos", 0, True),
            (15, "Beacon", 0, True),
            (16, "Ferry", 0, False),
            (17, "Quay", 0, False),
            (18, "Ghost", 0, True),
        ],
        "redirect": [
            (12, 0, "Harbour"),
            (14, 0, "Beacon"),
            (15, 0, "Lighthouse"),
            (17, 0, "Ferry"),
            (18, 0, "Nowhere"),
        ],
        "linktarget": [
            (101, "Harbour", 0),
            (102, "Port", 0),
            (103, "Lighthouse", 0),
            (104, "Pharos", 0),
            (105, "Beacon", 0),
            (106, "Ferry", 0),
            (107, "Quay", 0),
            (108, "Ghost", 0),
            (109, "Missing", 0),
        ],
        "pagelinks": [
            (11, 0, 103),
            (13, 0, 102),
            (16, 0, 107),
            (17, 0, 106),
            (16, 0, 105),
            (15, 0, 104),
            (14, 0, 104),
            (11, 0, 108),
            (11, 0, 109),
            (16, 0, 101),
        ],
    }


@pytest.fixture
def harbour(link_tables):
    return link_tables(**harbour_rows())


def rows(frame, *columns):
    """Sorted list of tuples."""
    picked = frame.select(*columns) if columns else frame
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: [(v is None, v) for v in r])


def plan(frame):
    """Executed physical plan as text; the final one if the frame was run."""
    return frame._jdf.queryExecution().executedPlan().toString()
