"""The corpus pipeline: five stages over ``documents``, each applied to all that the stage before kept.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read again as the next one's ``docs``. All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabspark.llm import decontaminate, near_text, packing, pii, toxicity
from tabspark.llm.q_packing import tokenizer_path
from tabspark.llm.q_toxicity import training_rows
from tabspark.llm.tasks import bounded_batches
from tabspark.session import ensure_checkpoint_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below 0.5; the lexicon is learned from labelled documents."""
    bounded_batches(spark)
    lexicon = toxicity.learn(training_rows(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), "toxic"))
    return toxicity.keep_clean(docs, lexicon)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class: the one with the smallest id. Rows without an id stay.

    Rows that repeat id and text are one document; ids are taken to be unique otherwise.
    """
    bounded_batches(spark)
    kept = near_text.near_duplicates(docs).where("kept").select("doc_id").distinct()
    one = docs.join(kept, "doc_id").select(*docs.columns).dropDuplicates(["doc_id", "text"])
    return one.unionByName(docs.where(F.col("doc_id").isNull()))


def drop_leaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    bounded_batches(spark)
    return decontaminate.remove_leaked(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with personal data replaced by its kind; ``n_chars`` follows the text."""
    bounded_batches(spark)
    out = pii.redact(docs, pii.train(docs))
    size = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.withColumn("n_chars", size).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in sequences of at most 2048, one row per piece."""
    bounded_batches(spark)
    return packing.pack(docs, tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_copies),
    ("decontamination", drop_leaked),
    ("personal_data", redact),
    ("packing", pack),
]

#: Learned models and hashing have no SQL form; tests hold every stage against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; between stages the rows lie as Parquet in the shared checkpoint folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{ensure_checkpoint_dir(spark)}/corpus_pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
