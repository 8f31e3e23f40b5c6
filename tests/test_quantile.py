"""Exact quantiles by sketches and refinement, against numpy; merged parts; widened ranges."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabspark.operators import encode, quantile

PROBS = [0.0, 0.001, 0.1, 0.25, 0.5, 0.5001, 0.9, 0.999, 1.0]


def got(df, probs, **how):
    out = {}
    for r in quantile.quantiles(df, probs, **how).collect():
        out.setdefault(r.feature, {})[r.idx] = r.value
    return {c: [v[i] for i in range(len(probs[c]))] for c, v in out.items()}


def frame(spark, **cols):
    names = list(cols)
    rows = [tuple(None if v is None else float(v) for v in r) for r in zip(*cols.values(), strict=True)]
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in names)).repartition(4)


@pytest.mark.parametrize("limit, error", [(1_000_000, quantile.ERROR), (40, quantile.ERROR), (40, 0.0)])
def test_equals_numpy(spark, limit, error):
    rng = np.random.default_rng(1)
    n = 6000
    cols = {"smooth": rng.normal(size=n), "ties": rng.integers(0, 5, n), "hot": np.where(rng.random(n) < 0.4, 7.0, rng.exponential(size=n)),
            "one": np.full(n, 3.5)}
    want = {c: np.quantile(v, PROBS).tolist() for c, v in cols.items()}
    result = got(frame(spark, **cols), {c: PROBS for c in cols}, limit=limit, error=error)
    for c in cols:
        assert result[c] == pytest.approx(want[c], rel=1e-12), c


def test_refines_in_several_passes(spark, monkeypatch):
    """With coarse sketches and a small limit the ranges shrink pass by pass, and the result stays exact."""
    monkeypatch.setattr(quantile, "SKETCH_K", 64)
    monkeypatch.setattr(quantile, "GRID", 16)
    rng = np.random.default_rng(2)
    x = rng.normal(size=20_000)
    passes = []
    real = quantile._coded
    monkeypatch.setattr(quantile, "_coded", lambda *a: passes.append(1) or real(*a))
    assert got(frame(spark, x=x), {"x": PROBS}, limit=50, error=0.02)["x"] == pytest.approx(np.quantile(x, PROBS).tolist(), rel=1e-12)
    assert len(passes) > 2


def test_nulls_nans_infinities(spark):
    df = frame(spark, x=[None, 1, 2, math.nan, 3, None, math.inf, -math.inf], y=[None] * 8, z=[math.nan] * 8)
    result = got(df, {"x": [0.0, 0.4, 0.8, 1.0], "y": [0.5], "z": [0.5]})
    assert "y" not in result and math.isnan(result["z"][0])
    assert result["x"][:3] == [-math.inf, 2.0, math.inf] and math.isnan(result["x"][3])


def test_own_probabilities_of_each_column(spark):
    df = frame(spark, a=range(101), b=range(101))
    assert got(df, {"a": [0.5], "b": [0.1, 0.9]}) == {"a": [50.0], "b": [10.0, 90.0]}


def test_merged_parts_are_close_and_new_parts_join(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=30_000)
    df = spark.createDataFrame([(float(v), i % 3) for i, v in enumerate(x)], "x double, part int")
    old = quantile.sketches(df.where("part < 2"), ["x"], "part")
    new = quantile.sketches(df.where("part = 2"), ["x"], "part")
    merged = quantile.merge(old.unionByName(new))
    row = merged.first()
    assert (row.n, row.n_nan, row.min, row.max) == (30_000, 0, x.min(), x.max())
    values = [r.value for r in quantile.approximate(merged, [0.1, 0.5, 0.9]).orderBy("idx").collect()]
    ranks = [(x <= v).mean() for v in values]
    assert ranks == pytest.approx([0.1, 0.5, 0.9], abs=0.01)


def test_buckets_of_different_numbers_share_the_passes(spark):
    df = frame(spark, a=range(1000), b=range(1000)).withColumn("id", F.monotonically_increasing_id())
    b = encode.bucketize_by_quantiles(df, ["a", "b"], {"a": 4, "b": 10})
    sizes = [sorted(r["count"] for r in b.groupBy(c).count().collect()) for c in "ab"]
    assert sizes == [[250] * 4, [100] * 10]
