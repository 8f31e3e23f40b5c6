import numpy as np
import pytest
from pyspark.sql import functions as F

from tabspark.llm import segment_search
from tabspark.llm.int_vectors import limit
from tabspark.llm.q_segment_search import SQL, op11_segment_search
from tabspark.plans.oracle_check import compare

from fixture_paths import SF_SMALL


def usable(v):
    return v is not None and all(x is not None and np.isfinite(x) for x in v)


def brute(rows, k):
    """(query_id, rank, vec_id, score) by plain loops; rows that can't be a candidate are left out."""
    out = []
    whole = [(i, [max(-limit(len(v)), min(limit(len(v)), int(np.floor(64 * x)))) for x in v]) if usable(v) else None
             for i, v in rows]
    for n, own in enumerate(whole):
        if own is None or own[0] is None or own[0] % 20:
            continue
        hits = [(-sum(a * b for a, b in zip(own[1], c[1], strict=True)), c[0] is None, c[0])
                for m, c in enumerate(whole) if m != n and c is not None and len(c[1]) == len(own[1])]
        out += [(own[0], r, c, -s) for r, (s, _, c) in enumerate(sorted(hits, key=lambda h: (h[0], h[1], h[2] or 0))[:k], 1)]
    return sorted(out, key=repr)


def search(df, **how):
    got = segment_search.top_k(df, F.col("vec_id") % 20 == 0, **how)
    assert [t for _, t in got.dtypes] == ["bigint", "int", "bigint", "bigint"]
    return sorted([tuple(r) for r in got.collect()], key=repr)


@pytest.mark.parametrize("candidates, queries, k", [(7, 3, 4), (64, 16, 20), (8192, 2048, 20)])
def test_equals_brute_force(spark, candidates, queries, k):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(12, 40))
    vectors = [(b + rng.normal(size=40) * 0.3).tolist() for b in base[rng.integers(0, 12, 300)]]
    vectors += vectors[:30] + [vectors[0]] * 25  # ties: copies
    vectors += [None, [], [], [float("nan")] * 40, [float("inf")] + [1.0] * 39, [None] * 40, [1.0, 2.0], [2.0, 4.0],
                [0.0] * 40, [1e300] * 40, [-1e300] + [5e5] * 39, [-0.01] * 40]
    ids = rng.permutation(len(vectors)).tolist()
    rows = list(zip(ids, vectors, strict=True)) + [(None, vectors[3]), (20, vectors[5]), (20, vectors[5]), (-40, vectors[6])]
    df = spark.createDataFrame([(i, v, "x", 1.0) for i, v in rows], "vec_id long, embedding array<double>, uid string, b double")
    assert search(df.repartition(5), candidates=candidates, queries=queries, k=k) == brute(rows, k)


def test_empty_and_unusable_tables(spark):
    df = spark.createDataFrame([(0, None), (20, [None, 1.0])], "vec_id long, embedding array<float>")
    assert search(df) == [] and search(df.limit(0)) == []


def test_bounds_hold_and_skip(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(8, 1, 64)) * 200 + np.repeat(rng.normal(size=(8, 1, 8)) * 200, 8, axis=2)
    x = np.floor(centres + rng.normal(size=(8, 100, 64)) * 20).astype(np.int64).reshape(-1, 64)
    score = x[:64] @ x.T
    threshold = np.sort(score, axis=1)[:, -20]
    mask = segment_search.survivors(x[:64], x, threshold)
    assert mask[score >= threshold[:, None]].all()  # nothing that reaches the threshold is lost
    assert mask.mean() < 0.3  # and most of the rest is never multiplied
    coarse = segment_search.survivors(x[:64], x, threshold, levels=(2,))
    assert (mask <= coarse).all() and coarse.mean() > mask.mean()


def test_query_and_sql(spark):
    r = compare(spark, SF_SMALL, "op11", op11_segment_search, SQL["op11_segment_search"])
    assert r["rows_match"] and r["schema_match"] and r["hash_match"], r
