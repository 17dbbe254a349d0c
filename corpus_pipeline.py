"""From raw documents to token ids: five stages, each written as a table and read again."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from linkloom.llm import decontam, pieces, quality, repeats, simhash
from linkloom.llm.queries import PIECE_MODEL
from linkloom.sources.workspace import Workspace, scope

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps, as they are."""
    return quality.keep_good(docs.select(*COLUMNS))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each SimHash group."""
    return simhash.one_of_each(docs.select(*COLUMNS), unique_ids=False)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that a document with a smaller id has.

    ``n_chars`` follows the text. A document of which no word is left goes; one without
    repeats stays as it is.
    """
    kept = repeats.remove_repeats(docs.select(*COLUMNS), carry=("lang", "source", "n_chars"))
    changed = F.col("n_removed") > 0
    return kept.where(~changed | (F.col("kept") != "")).select(
        "doc_id",
        F.col("kept_text").alias("text"),
        "lang",
        "source",
        F.when(changed, F.length("kept_text").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"),
    )


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark window occurs."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    judged = decontam.decontaminate(
        docs.select(*COLUMNS), items, carry=("text", "lang", "source", "n_chars")
    )
    return judged.where(~F.col("contaminated")).select(*COLUMNS)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, with digests of ids and decoded text."""
    return pieces.encode_and_decode(docs.select(*COLUMNS), PIECE_MODEL, with_ids=True)


STAGES = [
    ("quality classifier", good_documents),
    ("simhash near-dedup", one_of_each_group),
    ("substring dedup", without_repeats),
    ("benchmark decontamination", without_benchmarks),
    ("sentencepiece", token_ids),
]

# The classifier's and the fingerprints' verdicts cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each gives is a stored table that the next one reads.

    The tables that a stage works with go when it is written, and its result when the next one is.
    """
    work = Workspace(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    try:
        for number, (_, stage) in enumerate(STAGES):
            with scope():
                docs, _ = work.store(stage(spark, docs, sf_dir), f"stage-{number}")
            if number:
                work.drop(f"stage-{number - 1}")
    except BaseException:
        work.release()
        raise
    return docs
