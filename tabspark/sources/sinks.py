"""Sinks (A6): metric and feature tables written as Parquet.

A run's metrics are a long DataFrame ``(run, period, split, metric, value)``
built with ``unionByName`` (S2) and written per run, partitioned by run; a
run that is repeated replaces its own partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None,
                mode: str = "overwrite") -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def append_metrics(metrics: DataFrame, path: str, run: str) -> None:
    """Write one run's long metrics table under ``run=<name>``, in place of an earlier one of that name."""
    (metrics.withColumn("run", F.lit(run)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run").parquet(path))
