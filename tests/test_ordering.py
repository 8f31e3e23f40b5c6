"""Blocked global order statistics equal single-partition windows."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tabspark.operators import ordering, split


def test_seeded_rank_matches_window(spark):
    df = spark.range(5000).select(F.col("id"))
    got = ordering.seeded_rank(df, "id", 42).orderBy("id").collect()
    h = F.md5(F.concat(F.lit("42-"), F.col("id").cast("string")))
    w = Window.orderBy(h, F.col("id"))
    want = df.select("id", F.row_number().over(w).alias("rank")).orderBy("id").collect()
    assert [r["rank"] for r in got] == [r["rank"] for r in want]


def test_rank_is_bijection(spark):
    df = spark.range(3000)
    r = split.permute(df, "id", 7)
    agg = r.agg(F.min("rank"), F.max("rank"), F.countDistinct("rank")).first()
    assert tuple(agg) == (1, 3000, 3000)


def test_running_sum_by_value_with_groups(spark):
    rows = [(g, float(v), int(v) % 3 + 1) for g in ("a", "b") for v in range(1, 400)]
    df = spark.createDataFrame(rows, "g string, v double, w long")
    got = ordering.running_sum_by_value(df, "v", ["w"], groups=["g"], blocks=16)
    w = Window.partitionBy("g").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("g", "v", F.sum("w").over(w).alias("cum_w"))
    diff = got.select("g", "v", "cum_w").exceptAll(want)
    assert diff.count() == 0


def test_running_sum_descending(spark):
    df = spark.createDataFrame([(float(v), 1) for v in range(100)], "v double, w long")
    got = {r["v"]: r["cum_w"] for r in ordering.running_sum_by_value(df, "v", ["w"], descending=True,
                                                                     blocks=8).collect()}
    assert got[99.0] == 1 and got[0.0] == 100 and got[50.0] == 50


def test_running_sum_many_blocks(spark):
    rows = [(float((i * 7919) % 20011) / 3.0, i % 5 + 1) for i in range(20000)]
    df = spark.createDataFrame(rows, "v double, w long").dropDuplicates(["v"])
    got = {r.v: r.cum_w for r in ordering.running_sum_by_value(df, "v", ["w"], blocks=1000).collect()}
    w = Window.orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    want = {r.v: r.cum_w for r in df.select("v", F.sum("w").over(w).alias("cum_w")).collect()}
    assert got == want and len(got) == 20000
