"""Query op2: bytes of every document that belong to repeated strings of 200 bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabspark.llm import exact_spans
from tabspark.llm.tasks import bounded_batches


def op2_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return exact_spans.remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op2_suffix_array": op2_suffix_array}
SQL: dict[str, str] = {}
