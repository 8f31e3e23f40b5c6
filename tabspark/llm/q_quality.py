"""Query op6: a quality score for every document, learned from labels outside the held-out fifth."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabspark.llm import quality
from tabspark.llm.q_toxicity import held_out
from tabspark.llm.tasks import bounded_batches


def op6_co_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out(F.col("doc_id")))
    scored = quality.co_train(docs, labels, calibrate=F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1)
    return scored.select(F.col("id").alias("doc_id"), F.coalesce(held_out(F.col("id")), F.lit(False)).alias("held_out"),
                         "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "text_score", "meta_score")


QUERIES = {"op6_co_training": op6_co_training}
SQL: dict[str, str] = {}
