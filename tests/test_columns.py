"""Row-wise operators on hand-made rows (FIXTURES.md §4)."""

import math

from pyspark.sql import functions as F

from tabspark.functions import columns as C
from tabspark.operators import encode, transform


def _col(df, expr):
    return [r[0] for r in df.select(expr).collect()]


def test_fixed_buckets_worked_example(spark):
    df = spark.createDataFrame([(10001.0,), (42004.0,), (2500.0,), (18000.0,)], "x double")
    assert _col(df, encode.bucketize_fixed("x", [5000.0, 25000.0])) == [1, 2, 0, 1]


def test_duplicate_boundaries(spark):
    df = spark.createDataFrame([(12.0,), (13.0,), (24.0,), (25.0,)], "x double")
    assert _col(df, C.bucket_of("x", [13.0, 13.0, 25.0])) == [0, 2, 2, 3]


def test_range_one_hot_half_open(spark):
    df = spark.createDataFrame([(1, 32.0), (2, 33.0), (3, 43.999), (4, 44.0), (5, None)], "id long, x double")
    out = encode.range_one_hot(df, "x", [float(s) for s in range(32, 44)], 1.0, "lat").orderBy("id").collect()
    bits = [[v for k, v in r.asDict().items() if k != "id"] for r in out]
    assert bits[0].index(1.0) == 0 and sum(bits[0]) == 1
    assert bits[1].index(1.0) == 1 and sum(bits[1]) == 1
    assert bits[2].index(1.0) == 11 and sum(bits[2]) == 1
    assert sum(bits[3]) == 0
    assert all(b is None for b in bits[4])


def test_ratio_cap_nulls(spark):
    df = spark.createDataFrame([(6.0, 3.0), (1.0, 0.0), (None, 2.0)], "a double, b double")
    assert _col(df, C.safe_ratio("a", "b")) == [2.0, None, None]
    caps = spark.createDataFrame([(4.0,), (7.0,), (None,)], "x double")
    assert _col(caps, C.cap_upper("x", 5)) == [4.0, 5.0, None]
    assert _col(caps, C.clip("x", 5, 6)) == [5.0, 6.0, None]


def test_linear_scale_and_constant_column(spark):
    df = spark.createDataFrame([(1, 0.0, 3.0), (2, 5.0, 3.0), (3, 10.0, 3.0)], "id long, x double, c double")
    out = transform.linear_scale(df, ["x", "c"]).orderBy("id").collect()
    assert [r["x"] for r in out] == [-1.0, 0.0, 1.0]
    assert [r["c"] for r in out] == [None, None, None]


def test_log_zscore_binary(spark):
    df = spark.createDataFrame([(1, 0.0), (2, math.e - 1), (3, None)], "id long, x double")
    assert _col(df.orderBy("id"), C.log_normalize("x"))[:2] == [0.0, 1.0]
    assert _col(df.orderBy("id"), C.binary_threshold("x", 1.0)) == [0, 1, None]
    z = transform.z_score(spark.createDataFrame([(1, 1.0), (2, 3.0)], "id long, x double"), ["x"])
    vals = sorted(r["x"] for r in z.collect())
    assert abs(vals[0] + math.sqrt(0.5)) < 1e-12 and abs(vals[1] - math.sqrt(0.5)) < 1e-12


def test_one_hot_argmax_dot(spark):
    df = spark.createDataFrame([(2, [0.1, 0.9, 0.9]), (None, [1.0, 0.0, 0.0])], "i int, v array<double>")
    assert _col(df, C.one_hot("i", 4)) == [[0, 0, 1, 0], None]
    assert _col(df, C.argmax("v")) == [1, 0]
    assert _col(df, C.dot("v", "v")) == [0.01 + 0.81 + 0.81, 1.0]


def test_pad_to(spark):
    df = spark.createDataFrame([(["a"],), (["a", "b", "c"],)], "t array<string>")
    assert _col(df, C.pad_to("t", F.lit(3))) == [["a", "", ""], ["a", "b", "c"]]


def test_md5_bucket_range(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("s"))
    vals = _col(df, C.md5_bucket("s", 7))
    assert min(vals) >= 0 and max(vals) <= 6 and len(set(vals)) == 7
