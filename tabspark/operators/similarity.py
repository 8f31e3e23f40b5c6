"""Exact top-k inner products of all rows with each other.

Vectors lie in blocks, ordered by length and norm. A block knows its largest
norm and its cap on the unit sphere (a centre and the widest angle to it), so
a pair of blocks bounds all its products: norms times the cosine of what
remains of the angle between the centres. Every block is first compared with
itself, which gives each row a k-th best product; pairs of blocks whose bound
reaches neither block's smallest k-th product are skipped, the others are
compared by matrix products, one pair at a time. A window with a limit keeps
each row's k best.

Nothing is broadcast but the pairs' list of block numbers is joined with the
blocks; a task holds two blocks. Scores are rounded to six decimals before
they are ranked, so that the order of a sum's terms doesn't matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabspark.functions.columns import round6
from tabspark.session import materialize

#: Rows of a block, and what rounding may move a score by.
BLOCK, ROUNDING = 2048, 2e-6

_ROWS = "id long, no long, dim int, norm double, vec binary"
_BLOCKS = ("task long, seq long, dim int, nos array<long>, ids array<long>, vecs binary, top double, centre array<double>, "
           "angle double")
_FOUND = "no long, id long, other_no long, other long, score double"


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        size = batch.column(2).value_lengths().to_numpy()
        flat, ends = batch.column(2).flatten().to_numpy(), np.cumsum(size)
        vecs = [flat[e - n:e] for n, e in zip(size, ends, strict=True)]
        yield pa.RecordBatch.from_pydict({
            "id": batch.column(0), "no": batch.column(1), "dim": pa.array(size, pa.int32()),
            "norm": pa.array([float(np.sqrt(v @ v)) for v in vecs], pa.float64()),
            "vec": pa.array([v.astype("<f8").tobytes() for v in vecs], pa.binary())})


def cap(x: np.ndarray) -> tuple[float, np.ndarray, float]:
    """(largest norm, centre, widest angle to it) of the rows; a zero row makes the cap the whole sphere."""
    norm = np.sqrt((x * x).sum(axis=1))
    if not len(x) or not norm.all():
        return float(norm.max(initial=0.0)), np.zeros(x.shape[1]), math.pi
    unit = x / norm[:, None]
    centre = unit.sum(axis=0)
    length = np.sqrt(centre @ centre)
    if not length:
        return float(norm.max()), np.zeros(x.shape[1]), math.pi
    centre /= length
    return float(norm.max()), centre, float(np.arccos(np.clip((unit @ centre).min(), -1, 1)))


def _blocks(size: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seq, held, n = TaskContext.get().partitionId(), 0, [], 0

        def cut(rows: pa.Table) -> pa.RecordBatch:
            nonlocal seq
            dim = rows.column("dim")[0].as_py()
            raw = b"".join(rows.column("vec").to_pylist())
            top, centre, angle = cap(np.frombuffer(raw, "<f8").reshape(rows.num_rows, dim))
            seq += 1
            return pa.RecordBatch.from_pydict({
                "task": pa.array([task], pa.int64()), "seq": pa.array([seq - 1], pa.int64()), "dim": pa.array([dim], pa.int32()),
                "nos": pa.array([rows.column("no").to_pylist()], pa.list_(pa.int64())),
                "ids": pa.array([rows.column("id").to_pylist()], pa.list_(pa.int64())), "vecs": pa.array([raw], pa.binary()),
                "top": pa.array([top]), "centre": pa.array([centre.tolist()], pa.list_(pa.float64())), "angle": pa.array([angle])})

        def whole(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, n
            rows = pa.Table.from_batches(held)
            dims = rows.column("dim").to_numpy()
            edges = [0, *(np.flatnonzero(dims[1:] != dims[:-1]) + 1).tolist(), len(dims)]
            rest = len(dims)
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                for a in range(lo, hi, size):
                    if not last and hi == len(dims) and hi - a < size:
                        rest = a
                        break
                    yield cut(rows.slice(a, min(size, hi - a)))
            held, n = rows.slice(rest).to_batches(), len(dims) - rest

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                n += batch.num_rows
                if n >= 4 * size:
                    yield from whole(False)
        if n:
            yield from whole(True)

    return run


def _best(score: np.ndarray, least: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of each row's scores that reach ``least`` and, but for rounding, its k-th best."""
    if score.shape[1] > k:
        least = np.maximum(least, np.partition(score, score.shape[1] - k, axis=1)[:, score.shape[1] - k] - ROUNDING)
    return np.nonzero(score >= least[:, None])


def _compare(k: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                same, dim, na, ia, va, la, nb, ib, vb, lb = (batch.column(c)[r] for c in range(10))
                same, dim = same.as_py(), dim.as_py()
                na, ia, nb, ib = (x.values.to_numpy(zero_copy_only=False) for x in (na, ia, nb, ib))
                a = np.frombuffer(va.as_py(), "<f8").reshape(len(na), dim)
                b = np.frombuffer(vb.as_py(), "<f8").reshape(len(nb), dim)
                score = a @ b.T
                if same:
                    np.fill_diagonal(score, -np.inf)
                sides = [(score, na, ia, nb, ib, la)] + ([] if same else [(score.T, nb, ib, na, ia, lb)])
                for s, n1, i1, n2, i2, least in sides:
                    least = np.full(len(n1), -np.finfo(float).max if least.as_py() is None else least.as_py() - ROUNDING)
                    x, y = _best(s, least, k)
                    yield pa.RecordBatch.from_pydict({"no": pa.array(n1[x]), "id": pa.array(i1[x]), "other_no": pa.array(n2[y]),
                                                      "other": pa.array(i2[y]), "score": pa.array(s[x, y])})

    return run


def block_pairs(blocks: DataFrame, floors: DataFrame) -> DataFrame:
    """``(a, b, dim, least_a, least_b)``, a < b: blocks of one length whose bound reaches the floor of one of them.

    ``blocks`` has ``b, dim, top, centre, angle``; ``floors`` a block's
    smallest k-th product so far, where all its rows have one.
    """
    own = blocks.join(floors, "b", "left").select("b", "dim", "top", "centre", "angle", "least")
    a, b = (own.select(*[F.col(c).alias(f"{c}_{s}") for c in own.columns]) for s in "ab")
    dot = F.aggregate(F.zip_with("centre_a", "centre_b", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    between = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), dot))) - F.col("angle_a") - F.col("angle_b")
    apart = F.when((F.col("angle_a") >= math.pi) | (F.col("angle_b") >= math.pi), 0.0).otherwise(F.greatest(F.lit(0.0), between - 1e-6))
    bound = F.col("top_a") * F.col("top_b") * F.cos(F.least(apart, F.lit(math.pi)))
    floor = F.when(F.col("least_a").isNotNull() & F.col("least_b").isNotNull(), F.least("least_a", "least_b"))
    return (a.join(b, (F.col("dim_a") == F.col("dim_b")) & (F.col("b_a") < F.col("b_b")))
            .where(floor.isNull() | (bound + ROUNDING + F.abs(bound) * 1e-9 >= floor))
            .select(F.col("b_a").alias("a"), F.col("b_b").alias("b"), F.col("dim_a").alias("dim"),
                    F.col("least_a").alias("la"), F.col("least_b").alias("lb")))


def top_products(df: DataFrame, id_col: str, vector_col: str, k: int, block: int = BLOCK) -> DataFrame:
    """``id, rank, other, score``: each row's k rows with the largest inner products, ties by the smaller id.

    Rows whose vector is null or holds null or non-finite components take no
    part; vectors of other lengths aren't compared; a row isn't compared with
    itself, but with others of its id.
    """
    own = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vec"))
    own = own.where(F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    rows = materialize(own.select("id", F.monotonically_increasing_id().alias("no"), "vec").mapInArrow(_rows, _ROWS))
    parts = max(1, math.ceil(rows.count() / (4 * block)))
    order = [F.col("dim"), F.col("norm").desc(), F.col("no")]
    cut = materialize(rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).coalesce(parts)
                      .mapInArrow(_blocks(block), _BLOCKS))
    step = (cut.agg(F.max("seq").alias("m")).first()["m"] or 0) + 1
    cut = cut.withColumn("b", F.col("task") * step + F.col("seq"))
    none = F.lit(None).cast("double")
    payload = {s: cut.select(F.col("b").alias(s), F.col("nos").alias(f"n{s}"), F.col("ids").alias(f"i{s}"), F.col("vecs").alias(f"v{s}"))
               for s in "ab"}
    alone = cut.select(F.lit(True).alias("same"), "dim", "nos", "ids", "vecs", none.alias("la"), F.col("nos").alias("n2"),
                       F.col("ids").alias("i2"), F.col("vecs").alias("v2"), none.alias("lb"))
    by = Window.partitionBy("no").orderBy(F.desc("s6"), F.col("other").asc_nulls_last(), "other_no")

    def kept(found: DataFrame) -> DataFrame:
        return (found.withColumn("s6", round6("score")).withColumn("rank", F.row_number().over(by))
                .where(F.col("rank") <= k))

    first = materialize(kept(alone.mapInArrow(_compare(k), _FOUND)))
    member = cut.select("b", F.explode("nos").alias("no"))
    worst = first.where(F.col("rank") == k).select("no", "score")
    floors = (member.join(worst, "no", "left").groupBy("b")
              .agg(F.when(F.count("score") == F.count(F.lit(1)), F.min("score")).alias("least")))
    pairs = block_pairs(cut.select("b", "dim", "top", "centre", "angle"), floors)
    todo = pairs.join(payload["a"], "a").join(payload["b"], "b").select(
        F.lit(False).alias("same"), "dim", "na", "ia", "va", "la", "nb", "ib", "vb", "lb")
    every = first.drop("rank", "s6").unionByName(todo.mapInArrow(_compare(k), _FOUND))
    return kept(every).select("id", F.col("rank").cast("long").alias("rank"), "other", F.col("s6").alias("score"))
