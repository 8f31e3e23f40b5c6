import numpy as np
import pytest

from tabspark.llm import near_vectors


def brute(rows):
    n = len(rows)
    ok = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v in rows]
    top, links = list(range(n)), [0] * n

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    unit = [np.array(v, "f4").astype("f8") / np.linalg.norm(np.array(v, "f4").astype("f8")) if o else None
            for (_, v), o in zip(rows, ok, strict=True)]
    for i in range(n):
        for j in range(i):
            if ok[i] and ok[j] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.9:
                links[i] += 1
                links[j] += 1
                top[max(find(i), find(j))] = min(find(i), find(j))
    small = {}
    for i, (k, _) in enumerate(rows):
        small[find(i)] = min(small.get(find(i), k), k)
    return sorted((k, links[i], small[find(i)]) for i, (k, _) in enumerate(rows))


@pytest.mark.parametrize("block, axes", [(5, 2), (64, 3), (2048, 8)])
def test_equals_brute_force(spark, block, axes):
    rng = np.random.default_rng(0)
    base = rng.normal(size=(25, 8))
    vectors = [(b + rng.normal(size=8) * 0.25).astype("f4").tolist() for b in base[rng.integers(0, 25, 180)]]
    vectors += vectors[:20] + [vectors[0]] * 30 + [None, [], [0.0] * 8, [float("nan")] * 8, [float("inf")] + [1.0] * 7,
                                                   [None] * 8, [1.0, 2.0], [2.0, 4.0], [1e-30] * 8, [1e30] * 8, [-0.0] * 7 + [1.0]]
    rows = list(zip(rng.permutation(len(vectors)).tolist(), vectors, strict=True))
    rows.append(rows[0])  # a repeated row
    df = spark.createDataFrame([(k, v, "x", 1.0) for k, v in rows],
                               "vec_id long, embedding array<float>, node string, degree double").repartition(4)
    got = near_vectors.near_vectors(df, n_axes=axes, block=block).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == brute(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_an_id_with_several_vectors(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.1]), (3, [0.1, 1.0]), (1, [1.0, 0.0])]
    got = near_vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted(tuple(r) for r in got) == sorted([(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (1, 1, 1, True),
                                                    (3, 1, 1, False)])
    rows = [(5, [1.0, 0.0]), (7, [1.0, 0.1]), (7, [0.0, 1.0]), (6, [0.1, 1.0])]
    got = near_vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted(tuple(r) for r in got) == [(5, 1, 5, True), (6, 1, 6, True), (7, 1, 5, False), (7, 1, 6, False)]


def test_distant_parts_are_skipped():
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(40, 16))
    x = near_vectors.unit(np.repeat(centres, 32, axis=0) + rng.normal(size=(1280, 16)) * 0.1)
    near = near_vectors.near_parts(x, x, 0.9, 32)
    i, j = near_vectors.links(x, x, 0.9, 32)
    want = np.nonzero(x @ x.T >= 0.9)
    assert set(zip(i.tolist(), j.tolist(), strict=True)) == set(zip(want[0].tolist(), want[1].tolist(), strict=True))
    assert near.mean() < 0.2 and near.diagonal().all()
    i, j = near_vectors.links(x[:50], x[700:1250], 0.9, 32)  # parts of uneven sizes
    want = np.nonzero(x[:50] @ x[700:1250].T >= 0.9)
    assert sorted(zip(i, j, strict=True)) == sorted(zip(*want, strict=True))


def test_null_id_and_empty_table(spark):
    df = spark.createDataFrame([(None, [1.0, 0.0]), (1, [1.0, 0.0])], "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_vectors.near_vectors(df).collect()}
    assert got == {None: (0, None, False), 1: (0, 1, True)}
    assert near_vectors.near_vectors(df.limit(0)).count() == 0


def test_distant_blocks_are_skipped(spark):
    boxes = spark.createDataFrame([(i, 1, float(i), 0.0, i + 0.1, 0.1) for i in range(300)],
                                  "pos long, dim int, lo0 double, lo1 double, hi0 double, hi1 double")
    pairs = near_vectors.block_pairs(boxes, 0.4, 1).collect()
    assert {(r.a, r.b) for r in pairs} == {(i, i) for i in range(300)}
    pairs = near_vectors.block_pairs(boxes, 1.4, 1).collect()
    assert {(r.a, r.b) for r in pairs} == {(i, j) for i in range(300) for j in (i, i + 1) if j < 300}
