"""Command line of the batch job, for spark-submit."""

import argparse

from pyspark.sql import SparkSession

from linkloom.plans.job import run_job
from linkloom.schemas import SCHEMAS
from linkloom.sources.tables import load_tables


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="linkloom", description=__doc__)
    for name in SCHEMAS:
        parser.add_argument(f"--{name}", required=True, help=f"URI of the {name} table")
    parser.add_argument("--format", default="parquet", choices=["parquet", "json"])
    parser.add_argument("--output", required=True, help="folder for the results")
    parser.add_argument("--checkpoint-dir", help="default: spark.checkpoint.dir")
    parser.add_argument("--method", default="star", choices=["star", "min_label"])
    parser.add_argument("--overwrite", action="store_true")
    parser.add_argument("--run-id", help="name of the job: a second call goes on where the first stopped")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName("linkloom").getOrCreate()
    tables = load_tables(spark, {name: getattr(args, name) for name in SCHEMAS}, args.format)
    result = run_job(
        tables,
        args.output,
        args.checkpoint_dir,
        args.method,
        "overwrite" if args.overwrite else "errorifexists",
        args.run_id,
    )
    for step in result.rounds:
        print(f"round {step.round}: changed {step.changed} in {step.seconds:.2f} s")
    pairs = result.mutual_link_count.first()["n"]
    members = result.largest_component_vertices.count()
    print(f"{pairs} mutual links; {members} pages in the largest component")
    print(f"results below {args.output}")


if __name__ == "__main__":
    main()
