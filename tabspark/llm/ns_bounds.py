"""Exact integer k-means with ns-bounds.

Every vector keeps, for every centroid, its last exact squared distance and
the round in which that was taken; the history of all centroids is kept too.
In a later round a stored distance is loosened by the length of the
centroid's total displacement since that round (not by the sum of the
displacements round by round, which is never shorter): minus it for the
other centroids, plus it for the vector's own. Where the own upper bound is
below all lower bounds, the vector stays without a distance being taken.
Otherwise the own distance is taken exactly, and then that of each centroid
whose lower bound still reaches it; among these integers the smallest
decides, ties by the smaller number.

State goes from round to round as a table in the checkpoint folder. Sums of
the centroids are corrected by the vectors that changed their cluster only;
the driver holds the history: (rounds + 1) * k centroids.

Defined cases
* null vectors, those of another length and those with null or non-finite components are left out.
* seeds are the vectors first in ``seed_order``, null last, ties by the vectors' bytes; fewer vectors than k: that many centroids.
* equal vectors and repeated ids are rows of their own; a null id is kept, and seeds last.
* a centroid without vectors stays where it was, its inertia is that of no row.
* an empty table, or one without a usable vector, gives an empty table.
* components are cut at ``int_vectors.limit`` (beyond 2**27 for 64 components), so that a distance fits a long; a sum of
  distances that doesn't is null.
* columns besides id and vector are dropped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabspark.llm.int_vectors import integer_rows, matrix
from tabspark.llm.tasks import output_type, record_batch, stored

#: What is allowed for the rounding of a square root, of its argument's size.
SLACK = 1e-12

_STATE = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("vec", T.BinaryType()), T.StructField("cluster", T.IntegerType()),
    T.StructField("was", T.IntegerType()), T.StructField("taken", T.BinaryType()), T.StructField("at", T.BinaryType()),
    T.StructField("distance", T.LongType()), T.StructField("evaluations", T.IntegerType())])
_SUMS = T.StructType([T.StructField("cluster", T.IntegerType()), T.StructField("i", T.IntegerType()),
                      T.StructField("s", T.LongType())])


def squared(x: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to one centroid."""
    diff = x - centroid
    return (diff * diff).sum(axis=1)


def assign(x: np.ndarray, cluster: np.ndarray, taken: np.ndarray, at: np.ndarray,
           history: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(clusters, exact distances taken per row) for the newest centroids; ``taken`` and ``at`` are brought up to date.

    ``taken[i, j]`` is the squared distance of row i to centroid j in round
    ``at[i, j]``. ``history`` is (rounds, k, components).
    """
    now, k = len(history) - 1, history.shape[1]
    gone = np.sqrt(((history[-1] - history) ** 2).sum(axis=2).astype(np.float64)).T  # (k, rounds): total displacement
    moved = gone[np.arange(k)[None, :], at]
    known = np.sqrt(taken.astype(np.float64))
    room = SLACK * (known + moved)
    low, rows = known - moved - room, np.arange(len(x))
    up = (known + moved + room)[rows, cluster]
    low[rows, cluster] = np.inf
    evaluations = np.zeros(len(x), np.int64)
    open_ = np.flatnonzero((low <= up[:, None]).any(axis=1))
    for j in np.unique(cluster[open_]):
        own = open_[cluster[open_] == j]
        taken[own, j], at[own, j] = squared(x[own], history[-1, j]), now
    up[open_] = np.sqrt(taken[open_, cluster[open_]].astype(np.float64)) * (1 + SLACK)
    evaluations[open_] += 1
    fails = low[open_] <= up[open_][:, None]
    best, of = taken[open_, cluster[open_]], cluster[open_].copy()
    for j in range(k):
        at_j = np.flatnonzero(fails[:, j])
        if len(at_j):
            own = open_[at_j]
            d = squared(x[own], history[-1, j])
            taken[own, j], at[own, j] = d, now
            evaluations[own] += 1
            nearer = (d < best[at_j]) | ((d == best[at_j]) & (j < of[at_j]))
            best[at_j[nearer]], of[at_j[nearer]] = d[nearer], j
    out = cluster.copy()
    out[open_] = of
    return out, evaluations


def _round(history: np.ndarray, last: bool, schema: pa.Schema):
    """A round's state from the one before. The first has id and vec alone; the last takes every own distance."""
    now, k, dim = len(history) - 1, history.shape[1], history.shape[2]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x = matrix(batch.column("vec").to_pylist(), dim)
            if now:
                was = batch.column("cluster").to_numpy().astype(np.int64)
                taken = np.frombuffer(b"".join(batch.column("taken").to_pylist()), "<i8").reshape(n, k).copy()
                at = np.frombuffer(b"".join(batch.column("at").to_pylist()), "<i2").reshape(n, k).copy()
                cluster, count = assign(x, was, taken, at, history)
                count = count + batch.column("evaluations").to_numpy()
            else:
                was = np.full(n, -1)
                taken = np.stack([squared(x, c) for c in history[0]], axis=1)
                at = np.zeros((n, k), np.int16)
                cluster, count = taken.argmin(axis=1), np.full(n, k)
            rows = np.arange(n)
            if last:
                old = np.flatnonzero(at[rows, cluster] != now)
                for j in np.unique(cluster[old]):
                    own = old[cluster[old] == j]
                    taken[own, j], at[own, j] = squared(x[own], history[-1, j]), now
                count[old] += 1
            yield record_batch(schema, batch.column("id"), batch.column("vec"), pa.array(cluster), pa.array(was),
                               [r.tobytes() for r in taken], [r.tobytes() for r in at.astype("<i2")],
                               pa.array(taken[rows, cluster]), pa.array(count))

    return run


def _changes(k: int, dim: int, schema: pa.Schema):
    """What the rows of a task that changed their cluster add to and take from each centroid's sums; place dim counts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, dim + 1), np.int64)
        for batch in batches:
            x = matrix(batch.column("vec").to_pylist(), dim)
            x = np.concatenate([x, np.ones((len(x), 1), np.int64)], axis=1)
            new, was = batch.column("cluster").to_numpy(), batch.column("was").to_numpy()
            np.add.at(total, new, x)
            np.subtract.at(total, was[was >= 0], x[was >= 0])
        j, i = np.nonzero(total)
        yield record_batch(schema, j.tolist(), i.tolist(), total[j, i].tolist())

    return run


def cluster(vectors: DataFrame, k: int, rounds: int, dim: int, seed_order: Column, factor: float = 256.0,
            id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """(``id_col, cluster, distance, evaluations`` of every usable vector, the final centroids).

    ``seed_order`` is an expression over ``id_col``. ``rounds`` times all
    vectors are assigned and centroids moved, then they are assigned once more.
    """
    if not 0 <= rounds < 1 << 15:
        raise ValueError("rounds must be below 32768")
    rows = stored(integer_rows(vectors, id_col, vector_col, factor).where(F.col("dim") == dim).select("id", "vec"))
    seeds = (rows.withColumnRenamed("id", id_col).select(seed_order.alias("o"), "vec")
             .orderBy(F.col("o").asc_nulls_last(), "vec").limit(k).collect())
    spark = vectors.sparkSession
    if not seeds:
        return rows.selectExpr(f"id as `{id_col}`", "0 as cluster", "0L as distance", "0 as evaluations"), np.zeros((0, dim), np.int64)
    history = matrix([bytes(r["vec"]) for r in seeds], dim)[None].copy()
    k = len(seeds)
    sums = [[0] * (dim + 1) for _ in range(k)]
    state = rows
    for t in range(rounds + 1):
        state = stored(state.mapInArrow(_round(history, t == rounds, output_type(_STATE)), _STATE))
        if t == rounds:
            break
        changed = state.where(F.col("cluster") != F.col("was")).select("vec", "cluster", "was")
        for r in (changed.mapInArrow(_changes(k, dim, output_type(_SUMS)), _SUMS).groupBy("cluster", "i")
                  .agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()):
            sums[r["cluster"]][r["i"]] += int(r["s"])
        moved = [[s // own[dim] for s in own[:dim]] if own[dim] else history[-1, j].tolist() for j, own in enumerate(sums)]
        history = np.concatenate([history, np.array(moved, np.int64).reshape(1, k, dim)])
    return state.select(F.col("id").alias(id_col), "cluster", "distance", "evaluations"), history[-1]


def described(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``assigned`` with the inertia of its cluster and of all, and its centroid's digest."""
    exact = F.sum(F.col("distance").cast("decimal(38,0)"))
    own = {r["cluster"]: int(r["s"]) for r in assigned.groupBy("cluster").agg(exact.alias("s")).collect()}  # k rows at most

    def as_long(n: int) -> int | None:
        return n if n < 1 << 63 else None

    rows = [(j, as_long(own.get(j, 0)), as_long(sum(own.values())),
             hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()) for j, c in enumerate(centroids)]
    table = assigned.sparkSession.createDataFrame(
        rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(table), "cluster")  # a row per centroid
