"""Query op5: personal data in every document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabspark.llm import pii
from tabspark.llm.tasks import bounded_batches


def op5_skip_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = pii.find(docs, pii.train(docs))

    def n(column: str, kind: str):
        return F.size(F.filter(F.split(column, ","), lambda x: F.startswith(x, F.lit(f"{kind}:")))).cast("long")

    return found.select("doc_id", *[n("base", k).alias(f"n_{k}") for k in pii.KINDS],
                        F.sha2("base", 256).alias("base_sha256"), "spans",
                        sum(n("added", k) for k in pii.KINDS).alias("n_added"))


QUERIES = {"op5_skip_chain": op5_skip_chain}
SQL: dict[str, str] = {}
