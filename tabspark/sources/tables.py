"""Scans (A1-A4).

Reads are schema-first: CSV gets an explicit ``StructType`` (no
``inferSchema`` pass over the data); Parquet keeps its own schema and
Catalyst prunes columns and pushes filters into the scan.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabspark.functions.columns import terms_of

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: Sequence[str] | None = None) -> DataFrame:
    """One driver table; ``columns`` narrows the scan's ReadSchema."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def read_delimited(spark: SparkSession, path: str, schema: T.StructType | str,
                   header: bool = True, sep: str = ",") -> DataFrame:
    """A1: delimited file with a declared schema; with a header, columns are found by name.

    The first file's header gives the order. A file whose header has another
    order, or lacks a declared column, raises instead of giving one column
    the values of another.
    """
    declared = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    if not header:
        return spark.read.schema(declared).option("header", False).option("sep", sep).csv(path)
    names = spark.read.option("header", True).option("sep", sep).csv(path).columns
    missing = [f.name for f in declared.fields if f.name not in names]
    if missing:
        raise ValueError(f"the header of {path} lacks {missing}")
    types = {f.name: f.dataType for f in declared.fields}
    stored = T.StructType([T.StructField(n, types.get(n, T.StringType()), True) for n in names])
    rows = spark.read.schema(stored).option("header", True).option("enforceSchema", False).option("sep", sep).csv(path)
    return rows.select(*[f.name for f in declared.fields])


def numeric_schema(names: Sequence[str]) -> T.StructType:
    """All-double schema for an example table read from CSV."""
    return T.StructType([T.StructField(n, T.DoubleType(), True) for n in names])


def pack_label_vector(df: DataFrame, label_col: str, feature_cols: Sequence[str],
                      id_col: str | None = None) -> DataFrame:
    """C17: label by position, the rest packed into one ``ARRAY<DOUBLE>``."""
    sel = [F.col(label_col).cast("int").alias("label"),
           F.array(*[F.col(c).cast("double") for c in feature_cols]).alias("v")]
    if id_col:
        sel.insert(0, F.col(id_col).alias("id"))
    return df.select(*sel)


def read_headerless_vectors(spark: SparkSession, path: str, width: int,
                            sep: str = ",") -> DataFrame:
    """A2: headerless CSV, column 0 = label, 1..width = features.

    ``id`` is a hash of the row and of its ordinal among equal rows, so it
    doesn't depend on how the files are split (no positional zip later).
    """
    schema = T.StructType([T.StructField(f"_c{i}", T.DoubleType(), True)
                           for i in range(width + 1)])
    raw = spark.read.schema(schema).option("header", False).option("sep", sep).csv(path)
    cols = [F.col(c) for c in raw.columns]
    nth = F.row_number().over(Window.partitionBy(*cols).orderBy(F.lit(0)))
    raw = raw.withColumn("_id", F.xxhash64(*cols, nth))
    return pack_label_vector(raw, "_c0", [f"_c{i}" for i in range(1, width + 1)], id_col="_id")


def terms_table(docs: DataFrame, id_col: str, text_col: str, label_col: str | None = None) -> DataFrame:
    """A3: ragged term records ``(id, terms ARRAY<STRING>[, label DOUBLE])``."""
    sel = [F.col(id_col).alias("id"), terms_of(text_col).alias("terms")]
    if label_col:
        sel.append(F.col(label_col).cast("double").alias("label"))
    return docs.select(*sel)


def read_vocabulary_file(spark: SparkSession, path: str) -> DataFrame:
    """A4: whitespace-separated vocabulary file -> distinct ``term``."""
    words = spark.read.text(path).select(F.explode(F.split(F.col("value"), r"\s+")).alias("term"))
    return words.where(F.col("term") != "").distinct()
