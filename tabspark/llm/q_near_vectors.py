"""Query op9: links and components of all vectors of ``embeddings``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabspark.llm import near_vectors


def op9_epsilon_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES = {"op9_epsilon_grid": op9_epsilon_grid}
SQL: dict[str, str] = {}
