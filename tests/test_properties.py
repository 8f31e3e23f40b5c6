"""Property tests (hypothesis) for the core primitives against plain Python/numpy."""

import bisect

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabspark.functions import columns as C
from tabspark.operators import encode, transform

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
finite = st.floats(min_value=-1e6, max_value=1e6, allow_nan=False, allow_infinity=False)


@SETTINGS
@given(bounds=st.lists(finite, min_size=1, max_size=40), xs=st.lists(finite, min_size=1, max_size=30))
def test_count_le_matches_bisect(spark, bounds, xs):
    bounds = sorted(bounds)
    df = spark.createDataFrame([(i, x, bounds) for i, x in enumerate(xs)], "i long, x double, b array<double>")
    got = C.with_count_le(df, "b", "x", len(bounds), "n").orderBy("i").collect()
    assert [r["n"] for r in got] == [bisect.bisect_right(bounds, x) for x in xs]
    lam = df.select("i", C.bucket_of("x", "b").alias("n")).orderBy("i").collect()
    assert [r["n"] for r in lam] == [bisect.bisect_right(bounds, x) for x in xs]


@SETTINGS
@given(xs=st.lists(st.integers(min_value=-50, max_value=50), min_size=1, max_size=80),
       n=st.integers(min_value=2, max_value=11))
def test_exact_quantiles_match_numpy(spark, xs, n):
    df = spark.createDataFrame([(float(x),) for x in xs], "x double")
    probs = encode.probs_i_over_n(n)
    got = [r["value"] for r in encode.quantiles(df, ["x"], probs).orderBy("idx").collect()]
    want = np.quantile(np.array(xs, dtype=float), probs, method="linear")
    assert np.allclose(got, want, rtol=0, atol=1e-9)


@SETTINGS
@given(xs=st.lists(finite, min_size=2, max_size=60))
def test_linear_scale_range_and_buckets(spark, xs):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "id long, x double")
    sc = [r["x"] for r in transform.linear_scale(df, ["x"]).collect()]
    if max(xs) > min(xs):
        assert all(-1.0 - 1e-12 <= v <= 1.0 + 1e-12 for v in sc)
    else:
        assert all(v is None for v in sc)
    b = encode.bucketize_by_quantiles(df, ["x"], 5).agg(F.min("x"), F.max("x")).first()
    assert 0 <= b[0] and b[1] <= 4
