"""Query op3: every document packed into sequences of at most 2048 tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabspark.llm import packing
from tabspark.llm.tasks import bounded_batches


def tokenizer_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return packing.pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), tokenizer_path())


QUERIES = {"op3_packing": op3_packing}
SQL: dict[str, str] = {}
