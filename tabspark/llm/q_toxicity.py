"""Query op1: a toxicity score for every document, learned from labels outside the held-out fifth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabspark.llm import toxicity
from tabspark.llm.tasks import bounded_batches, bounded_labels, stored


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


#: Labelled rows that the models of this subpackage learn from, at most (about; see bounded_labels).
MAX_LABELLED = 30_000


def training_rows(docs: DataFrame, labels: DataFrame, column: str, max_rows: int = MAX_LABELLED) -> DataFrame:
    """``text`` and the label of labelled rows outside the held-out fifth, stored once."""
    own = labels.where(~held_out(F.col("doc_id")) & F.col(column).isin(0, 1)).select("doc_id", column)
    own = bounded_labels(own, "doc_id", max_rows)
    return stored(docs.select("doc_id", "text").join(F.broadcast(own), "doc_id").select("text", column))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    lexicon = toxicity.learn(training_rows(docs, labels, "toxic"))
    return toxicity.measure(docs, lexicon, "doc_id").select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_words", "n_matches")


QUERIES = {"op1_toxicity": op1_toxicity}
SQL: dict[str, str] = {}
