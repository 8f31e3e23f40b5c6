import hashlib

import numpy as np
import pytest

from tabspark.llm import ns_bounds
from tabspark.llm.int_vectors import limit
from tabspark.llm.q_ns_bounds import SQL, op13_ns_bounds, seed_hash
from tabspark.plans.oracle_check import compare

from fixture_paths import SF_SMALL


def digest(i):
    return "~" if i is None else hashlib.sha256(f"2:{i}".encode()).hexdigest()  # null last


def brute(rows, k, rounds, dim):
    top = limit(dim)
    kept = [(i, [max(-top, min(top, int(np.floor(256 * x)))) for x in v]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and np.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (digest(r[0]), np.array(r[1], "<i8").tobytes()))
    centres = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centres))

    for _ in range(rounds):
        own = [[] for _ in centres]
        for _, v in kept:
            own[nearest(v)[1]].append(v)
        centres = [[sum(col) // len(m) for col in zip(*m, strict=True)] if m else c for m, c in zip(own, centres, strict=True)]
    got = [(i, *nearest(v)) for i, v in kept]
    total = sum(d for _, d, _ in got)
    each = [sum(d for _, d, j in got if j == c) for c in range(len(centres))]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted([(i, j, d, each[j], total, sha[j]) for i, d, j in got], key=repr)


def run(df, k, rounds, dim):
    assigned, centres = ns_bounds.cluster(df, k, rounds, dim, seed_hash())
    out = ns_bounds.described(assigned, centres).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    assert [t for _, t in out.dtypes] == ["bigint", "int", "bigint", "bigint", "bigint", "string"]
    return sorted([tuple(r) for r in out.collect()], key=repr)


@pytest.mark.parametrize("k, rounds", [(1, 2), (9, 0), (9, 6), (40, 5), (500, 3)])
def test_equals_brute_force(spark, k, rounds):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(15, 6))
    vectors = [(b + rng.normal(size=6) * 0.4).tolist() for b in base[rng.integers(0, 15, 250)]]
    vectors += [vectors[0]] * 60 + (np.round(rng.normal(size=(60, 6)) * 2) / 256).tolist()  # copies, and many ties
    vectors += [None, [], [1.0], [float("nan")] * 6, [float("-inf")] + [0.0] * 5, [None] * 6, [1e300] * 6, [-1e300] * 6, [0.0] * 6]
    rows = list(zip(rng.permutation(len(vectors)).tolist(), vectors, strict=True))
    rows += [(None, vectors[1]), (None, vectors[2]), (7, vectors[3]), (7, vectors[3]), (7, vectors[4])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows],
                               "vec_id long, embedding array<double>, cluster int, distance string").repartition(4)
    assert run(df, k, rounds, 6) == brute(rows, k, rounds, 6)


def test_bounds_save_distances(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(12, 16))
    rows = [(i, (b + rng.normal(size=16) * 0.05).tolist()) for i, b in enumerate(base[rng.integers(0, 12, 600)])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assigned, _ = ns_bounds.cluster(df, 12, 8, 16, seed_hash())
    taken = sum(r.evaluations for r in assigned.collect())
    assert taken < 0.5 * 600 * 12 * 9  # of what a full scan of each round takes


def test_total_displacement_is_tighter_than_summed_drifts():
    history = np.array([[[0, 0], [900, 0]], [[50, 0], [900, 0]], [[0, 0], [900, 0]]])  # there and back
    x = np.array([[420, 0]])
    taken = np.stack([ns_bounds.squared(x, c) for c in history[0]], axis=1)
    got, count = ns_bounds.assign(x, np.array([0]), taken, np.zeros((1, 2), np.int16), history)
    assert got.tolist() == [0] and count.tolist() == [0]  # summed drifts (100) would have failed: 420 + 100 > 480


def test_empty_and_unusable_tables(spark):
    df = spark.createDataFrame([(0, None), (1, [1.0])], "vec_id long, embedding array<float>")
    assert run(df, 3, 2, 6) == [] and run(df.limit(0), 3, 2, 6) == []


def test_query_and_sql(spark):
    r = compare(spark, SF_SMALL, "op13", op13_ns_bounds, SQL["op13_ns_bounds"])
    assert r["rows_match"] and r["schema_match"] and r["hash_match"], r
