"""Fitted pipelines that are kept, reloaded and checked before they score.

A kept pipeline is Spark ML's own folder (statistics, vocabulary, model)
beside a table of the input columns it was fitted on. Reloading needs
nothing of the session that fitted it. Before scoring, the columns of the
table are held against the kept ones: a missing column or another type
raises; further columns are carried along.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_MODEL, _INPUTS = "model", "inputs"


class SchemaMismatch(ValueError):
    """A table lacks columns of a pipeline, or has them with other types."""


def fit_and_keep(train: DataFrame, stages: Sequence, inputs: Sequence[str], path: str) -> PipelineModel:
    """Fits the stages on ``train`` and keeps the pipeline with the types of its input columns at ``path``."""
    model = Pipeline(stages=list(stages)).fit(train.select(*inputs))
    model.write().overwrite().save(f"{path}/{_MODEL}")
    rows = [(c, train.schema[c].dataType.json()) for c in inputs]
    train.sparkSession.createDataFrame(rows, "name string, type string").coalesce(1).write.mode("overwrite").parquet(f"{path}/{_INPUTS}")
    return model


def load(spark: SparkSession, path: str) -> tuple[PipelineModel, dict[str, T.DataType]]:
    rows = spark.read.parquet(f"{path}/{_INPUTS}").collect()  # a row per input column
    return PipelineModel.load(f"{path}/{_MODEL}"), {r["name"]: T._parse_datatype_json_string(r["type"]) for r in rows}


def score(spark: SparkSession, path: str, df: DataFrame, optional: Sequence[str] = ()) -> DataFrame:
    """``df`` with the kept pipeline's output columns. ``optional`` inputs (a label) may be missing, then they are null."""
    model, inputs = load(spark, path)
    found = {f.name: f.dataType for f in df.schema.fields}
    wrong = [f"{c}: {t.simpleString()} expected, {found[c].simpleString() if c in found else 'nothing'} found"
             for c, t in inputs.items() if found.get(c) != t and not (c in optional and c not in found)]
    if wrong:
        raise SchemaMismatch("; ".join(wrong))
    for c in optional:
        if c not in found:
            df = df.withColumn(c, F.lit(None).cast(inputs[c]))
    return model.transform(df)
