"""Query op7: documents that hold benchmark items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabspark.llm import decontaminate
from tabspark.llm.tasks import bounded_batches


def op7_latent_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: whether it is leaked, its best item and how much of it it has."""
    bounded_batches(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.judged(docs, benchmark)


QUERIES = {"op7_latent_decontamination": op7_latent_decontamination}
SQL: dict[str, str] = {}
