"""Top-k inner products against all pairs; blocks that can't matter are skipped."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabspark.operators import similarity


def usable(v):
    return v is not None and all(x is not None and np.isfinite(x) for x in v)


def brute(rows, k):
    out = []
    for n, (i, v) in enumerate(rows):
        if not usable(v):
            continue
        hits = [(-(np.floor(float(np.dot(v, w)) * 1e6 + 0.5) / 1e6), j) for m, (j, w) in enumerate(rows)
                if m != n and usable(w) and len(w) == len(v)]
        out += [(i, r, j, round(-s, 6)) for r, (s, j) in enumerate(sorted(hits)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("block", [16, 4096])
def test_equals_brute_force(spark, block):
    rng = np.random.default_rng(1)
    vectors = [(rng.normal(size=6) * rng.exponential()).round(2).tolist() for _ in range(150)]
    vectors += vectors[:10] + [vectors[0]] * 5 + [[0.0] * 6, None, [], [1.0], [2.0, 1.0], [1.0, 1.0], [float("nan")] * 6,
                                                  [None, 1.0], [float("inf"), 1.0]]
    rows = list(zip(rng.permutation(len(vectors)).tolist(), vectors, strict=True)) + [(3, vectors[4])]
    df = spark.createDataFrame([(i, v, 1.0) for i, v in rows], "vec_id long, embedding array<double>, score double").repartition(3)
    got = similarity.top_products(df, "vec_id", "embedding", 4, block)
    assert sorted((r.id, r.rank, r.other, round(r.score, 6)) for r in got.collect()) == brute(rows, 4)


def test_empty_table(spark):
    df = spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")
    assert similarity.top_products(df, "vec_id", "embedding", 3).count() == 0


def test_far_and_short_blocks_are_skipped(spark):
    """Four directions with falling norms: blocks of one direction meet, short or distant ones don't."""
    rng = np.random.default_rng(2)
    rows = []
    for g in range(4):
        x = np.eye(8)[g] * (4 - g) * 10 + rng.normal(size=(64, 8)) * 0.01
        rows += [x[i:i + 16] for i in range(0, 64, 16)]
    blocks = [(b, 8, *(t if isinstance(t, float) else t.tolist() for t in similarity.cap(x))) for b, x in enumerate(rows)]
    table = spark.createDataFrame(blocks, "b long, dim int, top double, centre array<double>, angle double")
    floors = spark.createDataFrame([(b, float(np.sort(x @ x.T, axis=1)[:, -4].min())) for b, x in enumerate(rows)], "b long, least double")
    pairs = {(r.a, r.b) for r in similarity.block_pairs(table, floors).collect()}
    assert pairs == {(a, b) for a in range(16) for b in range(a + 1, 16) if a // 4 == b // 4}
    assert similarity.block_pairs(table, floors.limit(0)).count() == 16 * 15 / 2  # nothing is known yet
    assert similarity.block_pairs(table, floors.withColumn("least", F.lit(-1e9))).count() == 16 * 15 / 2
