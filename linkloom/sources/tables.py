"""Loaders for the four link tables: Parquet, JSON lines and the catalog."""

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from linkloom.schemas import SCHEMAS
from linkloom.sources.sinks import write_result


class LinkTables(NamedTuple):
    """The four inputs, each with the declared column names and types."""

    page: DataFrame
    redirect: DataFrame
    linktarget: DataFrame
    pagelinks: DataFrame

    def register(self) -> "LinkTables":
        """Create the temp views page, redirect, linktarget and pagelinks."""
        for name, frame in self._asdict().items():
            frame.createOrReplaceTempView(name)
        return self


def conform(frame: DataFrame, name: str) -> DataFrame:
    """Select the declared columns by name and cast them to the declared types.

    Dumps often carry the redirect flag as 0/1 and titles as binary. The casts
    vanish from the plan where the types already agree.
    """
    return frame.select(
        *(F.col(field.name).cast(field.dataType).alias(field.name) for field in SCHEMAS[name])
    )


def read_parquet_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """One table from Parquet; ``path`` is any URI that Spark can read."""
    return conform(spark.read.parquet(path), name)


def read_jsonl_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """One table from JSON lines (LF or CRLF), without schema inference.

    The flag is read as text, which takes true/false as well as 0/1. A row that
    does not fit the schema fails the read rather than turning into NULLs.
    """
    as_read = T.StructType(
        [
            T.StructField(f.name, T.StringType() if f.dataType == T.BooleanType() else f.dataType)
            for f in SCHEMAS[name]
        ]
    )
    return conform(spark.read.schema(as_read).option("mode", "FAILFAST").json(path), name)


class Quarantined(NamedTuple):
    """A table of the lines that could be read, and a stored one (text, reason, file) of those that could not."""

    table: DataFrame
    bad: DataFrame
    n_bad: int


def quarantine_jsonl_table(
    spark: SparkSession, name: str, path: str, quarantine: str, mode: str = "errorifexists"
) -> Quarantined:
    """One table from JSON lines, of which those that do not fit are set aside below ``quarantine``.

    A line is bad if it is no JSON object, or if a declared field has a value that is not of its type; the
    reason names the first such field. Fields that are missing or null are NULL, unknown ones are ignored,
    and empty lines are skipped, as in ``read_jsonl_table``. Bad lines are written and counted in one job; the
    table stays lazy.
    """
    fields = SCHEMAS[name].fields
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in fields])
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    # Any JSON object is a map of texts; whatever is none is NULL.
    parsed = lines.where(F.trim("value", F.lit(" \t\r")) != "").select(
        "value",
        "file",
        F.from_json("value", T.MapType(T.StringType(), T.StringType())).alias("object"),
        F.from_json("value", as_text).alias("raw"),
    )

    def value(field):
        return F.col("raw")[field.name].try_cast(field.dataType)

    reason = F.when(F.col("object").isNull(), F.lit("not a JSON object"))
    for field in fields:
        misfit = F.col("raw")[field.name].isNotNull() & value(field).isNull()
        reason = reason.when(misfit, F.lit(f"{field.name} is no {field.dataType.simpleString()}"))
    judged = parsed.withColumn("reason", reason)
    table = judged.where(F.col("reason").isNull()).select(
        *(value(field).alias(field.name) for field in fields)
    )
    seen = Observation()
    bad = judged.where(F.col("reason").isNotNull()).select(F.col("value").alias("text"), "reason", "file")
    stored = write_result(bad.observe(seen, F.count("*").alias("n")), quarantine, mode)
    return Quarantined(table, stored, seen.get["n"])


_READERS = {"parquet": read_parquet_table, "json": read_jsonl_table}


def load_tables(
    spark: SparkSession,
    paths: Mapping[str, str],
    fmt: str = "parquet",
    quarantine: str | None = None,
) -> LinkTables:
    """Load the four tables; ``paths`` maps each table name to its URI.

    With ``quarantine``, lines of JSON tables that do not fit go to a table of their own below
    that folder, named like the table, and the others are loaded; without it one such line fails the read.
    """
    if fmt not in _READERS:
        raise ValueError(f"unknown format {fmt!r}; use one of {sorted(_READERS)}")
    if quarantine is not None:
        if fmt != "json":
            raise ValueError("only JSON lines can be quarantined")
        return LinkTables(
            **{
                name: quarantine_jsonl_table(spark, name, paths[name], f"{quarantine}/{name}").table
                for name in SCHEMAS
            }
        )
    return LinkTables(**{name: _READERS[fmt](spark, name, paths[name]) for name in SCHEMAS})


def tables_from_catalog(
    spark: SparkSession, names: Mapping[str, str] | None = None
) -> LinkTables:
    """Take the tables from registered views or catalog tables.

    ``names`` overrides single table names, for instance ``{"page": "crawl.page"}``.
    """
    names = names or {}
    return LinkTables(
        **{name: conform(spark.table(names.get(name, name)), name) for name in SCHEMAS}
    )
