"""Query op10: near-duplicate classes of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabspark.llm import near_text
from tabspark.llm.tasks import bounded_batches


def op10_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return near_text.near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op10_order_minhash": op10_order_minhash}
SQL: dict[str, str] = {}
