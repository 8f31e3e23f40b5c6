"""Merged profile states against the direct results; new files are read once."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabspark.operators import profile, profile_state

COLS = ["a", "b", "c"]


def frame(spark, n=900, shift=1e6):
    rng = np.random.default_rng(1)
    a = rng.normal(size=n) + shift  # a large mean: sums of squares would lose the deviations
    b = 2 * a + rng.normal(size=n)
    rows = [(float(x), float(y) if i % 7 else None, 4.0, i % 5) for i, (x, y) in enumerate(zip(a, b, strict=True))]
    return spark.createDataFrame(rows, "a double, b double, c double, part int")


def table(df):
    return {(r.col_a, r.col_b): r for r in df.collect()}


def test_merged_equals_direct(spark):
    df = frame(spark)
    merged = profile_state.merge(profile_state.states(df, COLS, "part"))
    whole = table(profile_state.merge(profile_state.states(df, COLS, F.lit("all"))))
    for key, r in table(merged).items():
        assert r.n == whole[key].n
        for c in ("mean_a", "mean_b", "m2_a", "m2_b", "c_ab", "min_a", "max_a"):
            assert r[c] == pytest.approx(whole[key][c], rel=1e-6, abs=1e-6), (key, c)
    direct = {r.feature: r for r in profile.describe(df, COLS).collect()}
    for r in profile_state.describe(merged).collect():
        want = direct[r.feature]
        assert (r["count"], r["min"], r["max"]) == (want["count"], want["min"], want["max"])
        assert r["std"] == pytest.approx(want["std"], rel=1e-6, abs=1e-9) and r["mean"] == pytest.approx(want["mean"])
    pairs = {(r.col_a, r.col_b): r.r for r in profile_state.corr(merged).collect()}
    for r in profile.corr_matrix(df, COLS).collect():
        got = pairs[r.col_a, r.col_b]
        assert (got is None) == (r.r is None) and (got is None or got == pytest.approx(r.r, abs=1e-6))
    assert pairs["a", "c"] is None  # a constant column


def test_merging_is_associative(spark):
    df = frame(spark)
    parts = profile_state.states(df, COLS, "part")
    some = profile_state.merge(parts.where("part < 2")).withColumn("part", F.lit("x"))
    rest = parts.where("part >= 2").select(*some.columns)
    two = table(profile_state.merge(some.unionByName(rest)))
    one = table(profile_state.merge(parts))
    assert all(two[k].c_ab == pytest.approx(r.c_ab, rel=1e-9, abs=1e-6) and two[k].n == r.n for k, r in one.items())


def test_least_squares_from_the_state(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, 2)) * [1, 100] + [5, -300]
    y = x @ [3.0, -0.5] + 7
    df = spark.createDataFrame([(*map(float, r), float(v), i % 3) for i, (r, v) in enumerate(zip(x, y, strict=True))],
                               "u double, v double, y double, part int")
    w, b = profile_state.least_squares(profile_state.merge(profile_state.states(df, ["u", "v", "y"], "part")), ["u", "v"], "y")
    assert np.allclose(w, [3.0, -0.5]) and b == pytest.approx(7.0)


def test_files_are_read_once(spark, tmp_path):
    df = frame(spark)
    files = []
    for p in range(3):
        files.append(str(tmp_path / f"f{p}.parquet"))
        df.where(F.col("part") % 3 == p).select(*COLS).write.parquet(files[-1])
    path, read = str(tmp_path / "state"), []

    def reader(f):
        read.append(f)
        return spark.read.parquet(f)

    assert profile_state.extend(spark, path, files[:2], COLS, reader) == files[:2]
    assert profile_state.extend(spark, path, files, COLS, reader) == files[2:]
    assert profile_state.extend(spark, path, files, COLS, reader) == [] and read == files
    got = table(profile_state.merge(spark.read.parquet(path)))
    want = table(profile_state.merge(profile_state.states(df, COLS, "part")))
    assert all(got[k].n == r.n and got[k].c_ab == pytest.approx(r.c_ab, rel=1e-6, abs=1e-6) for k, r in want.items())


def test_empty_parts(spark):
    df = spark.createDataFrame([(None, 1.0, "x"), (2.0, None, "y")], "a double, b double, part string")
    got = table(profile_state.merge(profile_state.states(df, ["a", "b"], "part")))
    assert got["a", "b"].n == 0 and got["a", "b"].mean_a is None and got["a", "a"].mean_a == 2.0
    assert profile_state.merge(profile_state.states(df.limit(0), ["a", "b"], "part")).count() == 0
