"""Vectors as exact integers: every component x becomes floor(factor * x), x as a double.

Factors are powers of two, so the product has no rounding. Components are
cut at plus or minus ``limit(length)``: beyond it a sum of squares or
products of one vector pair would not fit a long.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabspark.llm.tasks import output_type, record_batch

ROWS = T.StructType([T.StructField("id", T.LongType()), T.StructField("dim", T.IntegerType()),
                     T.StructField("vec", T.BinaryType())])


def limit(dim: int) -> int:
    """Largest magnitude of a component: squared differences of ``dim`` of them stay below 2**62."""
    return math.isqrt((1 << 60) // max(1, dim))


def _integers(factor: float, schema: pa.Schema):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # null components: not a number
            size = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum(size)
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
            ok = lists.is_valid().to_numpy(zero_copy_only=False) & (bad[ends] == bad[ends - size])
            keep = np.flatnonzero(ok)
            with np.errstate(over="ignore", invalid="ignore"):
                whole = np.floor(flat * factor)
            vecs = []
            for i in keep:
                top = limit(int(size[i]))
                vecs.append(np.clip(whole[ends[i] - size[i]:ends[i]], -top, top).astype("<i8").tobytes())
            yield record_batch(schema, batch.column(0).take(pa.array(keep)), size[keep].tolist(), vecs)

    return run


def integer_rows(vectors: DataFrame, id_col: str, vector_col: str, factor: float) -> DataFrame:
    """``id, dim, vec`` (little-endian 64-bit integers) of every usable vector; the others are left out."""
    own = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>"))
    return own.mapInArrow(_integers(factor, output_type(ROWS)), ROWS)


def matrix(raw: list[bytes], dim: int) -> np.ndarray:
    """The vectors of one length as rows of 64-bit integers."""
    return np.frombuffer(b"".join(raw), "<i8").reshape(len(raw), dim)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of all rows of a and b, exact: by floating point where every partial sum is below 2**53."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    if a.shape[1] * int(np.abs(a).max()) * int(np.abs(b).max()) < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T
