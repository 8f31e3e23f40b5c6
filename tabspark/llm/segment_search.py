"""Exact top-k search by multi-resolution segment statistics.

Queries and candidates are vectors of integers. For segments of length L
with means m and deviations s, the squared distance of two vectors is at
least the sum over segments of L * ((m - m')**2 + (s - s')**2), and finer
segments give a larger bound. As the inner product is half of what the
squared norms exceed the squared distance by, that lower bound on distance
is the upper bound sum(L * (m * m' + s * s')) on the score.

Candidates and queries lie in blocks; a task compares a block of queries
with a block of candidates, from the coarsest segments to the finest: a
candidate stays for a query while its bound reaches the query's threshold,
and survivors get their exact product. The threshold is the k-th best exact
score so far. Candidate blocks are taken in rounds of growing shares (one
block, then eight times as many, by a hash of the block), so that later
rounds know good thresholds and give few rows; a round's rows are ranked per
query by a window with a limit. The number of rounds is the logarithm of
the number of blocks.

Defined cases
* null vectors and those with null or non-finite components take no part; empty vectors score 0 with each other.
* only vectors of the query's own length are its candidates.
* a query's own row is no candidate, another row with the same id is. Repeated query rows each get a result.
* ties go to the smaller id, a null id last; a null id is never a query.
* fewer than k candidates: all of them. An empty table gives an empty table.
* components are cut at ``int_vectors.limit`` (beyond 2**27 for 64 components), so that scores fit a long.
* columns besides id and vector are dropped, but may be used by ``is_query``.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabspark.llm.int_vectors import integer_rows, matrix, products
from tabspark.llm.tasks import output_type, record_batch, stored

#: Vectors in a block of candidates and of queries, segments of each resolution, growth of a round.
CANDIDATES, QUERIES, LEVELS, GROWTH = 8192, 2048, (2, 8, 32), 8
#: Queries that are compared at once, candidates that give a block's first thresholds, entries of an id that is null.
TILE, SEED, NO_ID = 256, 1024, np.iinfo(np.int64).max
_LEAST = np.iinfo(np.int64).min

_BLOCK = T.StructType([T.StructField("task", T.LongType()), T.StructField("seq", T.LongType()),
                       T.StructField("dim", T.IntegerType()), T.StructField("uids", T.ArrayType(T.LongType())),
                       T.StructField("ids", T.ArrayType(T.LongType())), T.StructField("narrow", T.BooleanType()),
                       T.StructField("vecs", T.BinaryType())])
_FOUND = T.StructType([T.StructField(n, T.LongType()) for n in ("qb", "qi", "quid", "query_id", "uid", "vec_id", "score")])


def statistics(x: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of each segment, both times the root of its length."""
    edges = np.linspace(0, x.shape[1], min(segments, x.shape[1]) + 1).astype(int)
    size = np.diff(edges)
    x = x.astype(np.float64)
    mean = np.add.reduceat(x, edges[:-1], axis=1) / size
    rest = x - np.repeat(mean, size, axis=1)
    return mean * np.sqrt(size), np.sqrt(np.add.reduceat(rest * rest, edges[:-1], axis=1))


def survivors(q: np.ndarray, c: np.ndarray, threshold: np.ndarray, levels: tuple[int, ...] = LEVELS) -> np.ndarray:
    """A mask (queries, candidates): no pair outside it has a score of at least the query's threshold."""
    mask = np.ones((len(q), len(c)), bool)
    if not q.shape[1]:
        return mask
    norm = np.sqrt((q.astype(np.float64) ** 2).sum(axis=1)) * np.sqrt((c.astype(np.float64) ** 2).sum(axis=1)).max(initial=0)
    least = threshold.astype(np.float64) - 0.5 - 1e-9 * norm  # scores are integers; the rest covers rounding
    live = np.arange(len(c))
    for m in levels:
        if m >= q.shape[1] or not len(live):
            break
        (qm, qs), (cm, cs) = statistics(q, m), statistics(c[live], m)
        near = qm @ cm.T + qs @ cs.T >= least[:, None]
        mask[:, live] &= near
        keep = mask[:, live].any(axis=0)
        live = live[keep]
    return mask


def _best_in_block(q: np.ndarray, c: np.ndarray, order: np.ndarray, threshold: np.ndarray, own: np.ndarray,
                   k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, candidate, score) of each query's k best candidates that reach its threshold.

    ``order`` ranks the candidates in ties; ``own`` is the query's own candidate, -1 for none.
    """
    rows = np.arange(len(q))
    if (threshold == _LEAST).any() and len(c) > k:  # the k-th best of some candidates bounds the k-th best of all
        some = products(q, c[:SEED])
        hit = (own >= 0) & (own < some.shape[1])
        some[rows[hit], own[hit]] = _LEAST
        if some.shape[1] > k:
            threshold = np.maximum(threshold, np.partition(some, some.shape[1] - k, axis=1)[:, some.shape[1] - k])
    mask = survivors(q, c, threshold)
    mask[rows[own >= 0], own[own >= 0]] = False
    live = np.flatnonzero(mask.any(axis=0))
    i, j = np.nonzero(mask[:, live])
    score = products(q, c[live])[i, j]
    j = live[j]
    keep = score >= threshold[i]
    i, j, score = i[keep], j[keep], score[keep]
    by = np.lexsort((order[j], -score, i))
    i, j, score = i[by], j[by], score[by]
    first = np.searchsorted(i, rows)
    keep = np.arange(len(i)) - first[i] < k
    return i[keep], j[keep], score[keep]


def _blocks(size: int, schema: pa.Schema):
    """A task's rows in blocks of one vector length, ``size`` at a time."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seq = TaskContext.get().partitionId(), 0
        held: dict[int, list[tuple]] = {}
        n = 0

        def cut(dim: int, rows: list[tuple]) -> pa.RecordBatch:
            nonlocal seq
            x = matrix([r[2] for r in rows], dim)
            narrow = not x.size or int(np.abs(x).max()) < 1 << 15
            out = record_batch(schema, [task], [seq], [dim], [[r[0] for r in rows]], [[r[1] for r in rows]], [narrow],
                               [x.astype("<i2").tobytes() if narrow else x.tobytes()])
            seq += 1
            return out

        for batch in batches:
            for uid, key, dim, vec in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = held.setdefault(dim, [])
                own.append((uid, key, vec))
                n += 1
                if len(own) == size or n >= 4 * size:
                    full = [dim] if len(own) == size else list(held)
                    for d in full:
                        n -= len(held[d])
                        yield cut(d, held.pop(d))
        for d, rows in held.items():
            yield cut(d, rows)

    return run


def _unpacked(uids, ids, narrow, vecs, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    uid = uids.values.to_numpy()
    key = ids.values.fill_null(NO_ID).to_numpy()
    return uid, key, np.frombuffer(vecs.as_py(), "<i2" if narrow.as_py() else "<i8").reshape(len(uid), dim).astype(np.int64)


def _search(k: int, schema: pa.Schema):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                qb, dim, known, *rest = (batch.column(n)[r] for n in range(11))
                dim = dim.as_py()
                quid, qid, q = _unpacked(*rest[:4], dim)
                uid, key, c = _unpacked(*rest[4:], dim)
                threshold = np.full(len(q), _LEAST)
                if known.is_valid:
                    threshold[known.values.field(0).to_numpy()] = known.values.field(1).to_numpy()
                order = np.empty(len(c), np.int64)
                order[np.lexsort((uid, key))] = np.arange(len(c))
                own = np.full(len(q), -1)
                _, at_q, at_c = np.intersect1d(quid, uid, assume_unique=True, return_indices=True)
                own[at_q] = at_c
                for lo in range(0, len(q), TILE):
                    part = slice(lo, lo + TILE)
                    i, j, score = _best_in_block(q[part], c, order, threshold[part], own[part], k)
                    i = i + lo
                    yield record_batch(schema, [qb.as_py()] * len(i), pa.array(i), pa.array(quid[i]), pa.array(qid[i]),
                                       pa.array(uid[j]), pa.array(key[j], mask=key[j] == NO_ID), pa.array(score))

    return run


def _numbered(rows: DataFrame, size: int) -> tuple[DataFrame, int]:
    """Blocks of ``rows`` with a number below the second result; not every number need occur."""
    n_tasks = max(1, math.ceil(rows.count() / (2 * size)))
    out = stored(rows.coalesce(n_tasks).mapInArrow(_blocks(size, output_type(_BLOCK)), _BLOCK))
    top = out.agg(F.max("seq").alias("s"), F.max("task").alias("t")).first()
    step = (top["s"] or 0) + 1
    return out.withColumn("b", F.col("task") * step + F.col("seq")), ((top["t"] or 0) + 1) * step


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, factor: float = 64.0, id_col: str = "vec_id",
          vector_col: str = "embedding", candidates: int = CANDIDATES, queries: int = QUERIES) -> DataFrame:
    """``query_id, rank, vec_id, score`` of each query's k best rows. ``is_query`` is an expression over ``id_col``."""
    rows = stored(integer_rows(vectors, id_col, vector_col, factor)
                  .withColumn("uid", F.monotonically_increasing_id()).select("uid", "id", "dim", "vec"))
    asked = rows.withColumnRenamed("id", id_col).where(F.col(id_col).isNotNull() & is_query).withColumnRenamed(id_col, "id")
    cands, n_blocks = _numbered(rows, candidates)
    asks, _ = _numbered(asked, queries)
    asks = asks.select(F.col("b").alias("qb"), F.col("dim").alias("q_dim"), F.col("uids").alias("q_uids"),
                       F.col("ids").alias("q_ids"), F.col("narrow").alias("q_narrow"), F.col("vecs").alias("q_vecs"))
    by_rank = Window.partitionBy("quid").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), "uid")
    draw = F.pmod(F.xxhash64("b"), F.lit(1 << 40)) / float(1 << 40)
    best, lo, hi = None, 0.0, 1.0 / max(1, n_blocks)
    while lo < 1.0:
        due = asks.withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)).cast("array<long>")))
        due = due.where((draw >= lo) & (draw < min(hi, 1.0)))
        known = F.lit(None).cast("array<struct<qi: long, score: long>>")
        if best is not None:
            reached = (best.where(F.col("rank") == k).groupBy("qb")
                       .agg(F.collect_list(F.struct("qi", "score")).alias("known")))  # at most a block's queries
            due, known = due.join(reached, "qb", "left"), F.col("known")
        pairs = due.join(cands, (due["b"] == cands["b"]) & (due["q_dim"] == cands["dim"])).select(
            "qb", "dim", known.alias("known"), "q_uids", "q_ids", "q_narrow", "q_vecs", "uids", "ids", "narrow", "vecs")
        found = pairs.mapInArrow(_search(k, output_type(_FOUND)), _FOUND)
        if best is not None:
            found = found.unionByName(best.drop("rank"))
        best = stored(found.withColumn("rank", F.row_number().over(by_rank)).where(F.col("rank") <= k))
        lo, hi = hi, hi * GROWTH
    return best.select("query_id", "rank", "vec_id", "score")
