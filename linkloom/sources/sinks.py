"""Result sinks."""

from pyspark.sql import DataFrame, SparkSession


def write_result(frame: DataFrame, path: str, mode: str = "errorifexists") -> DataFrame:
    """Write a result as Parquet and return it re-read from ``path``.

    Going on from the files spares the next step the whole plan behind them.
    """
    spark: SparkSession = frame.sparkSession
    schema = frame.schema
    frame.write.mode(mode).parquet(path)
    return spark.read.schema(schema).parquet(path)
