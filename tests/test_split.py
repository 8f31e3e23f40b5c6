"""Split properties: disjoint, complete, deterministic."""

from pyspark.sql import functions as F

from tabspark.operators import split


def test_fraction_split_disjoint_complete(spark):
    df = spark.range(20000)
    s = split.fraction_split(df, split.TRAIN_VALID_TEST)
    counts = {r["split"]: r["count"] for r in s.groupBy("split").count().collect()}
    assert sum(counts.values()) == 20000
    assert abs(counts["train"] / 20000 - 0.6) < 0.02
    again = split.fraction_split(df, split.TRAIN_VALID_TEST)
    assert s.exceptAll(again).count() == 0


def test_head_tail_paths_agree(spark, monkeypatch):
    df = spark.range(2000)
    small = {r.id for r in split.head(df, 700).collect()}
    tail_small = {r.id for r in split.tail(df, 500).collect()}
    monkeypatch.setattr(split, "TOP_N_LIMIT", 10)
    big = {r.id for r in split.head(df, 700).collect()}
    tail_big = {r.id for r in split.tail(df, 500).collect()}
    assert small == big and tail_small == tail_big
    assert len(small & tail_small) == 0  # 700 + 500 <= 2000


def test_slice_and_sample(spark):
    df = spark.range(1000)
    sl = split.slice_rows(df, 100, 250)
    assert sl.count() == 150
    assert sl.agg(F.min("rank"), F.max("rank")).first() == (101, 250)
    assert split.sample_n(df, 37).count() == 37


def test_prefix_candidates_and_fallback(spark, monkeypatch):
    df = spark.range(5000).select((F.col("id") * 7 % 5003).alias("id"))
    want = sorted(r.id for r in df.orderBy("id").limit(321).collect())
    assert sorted(r.id for r in split.prefix(df, 321).collect()) == want
    assert sorted(r.id for r in split.prefix(df, 321).collect()) == want


def test_head_tail_split_guard(spark):
    import pytest

    df = spark.range(100)
    s = split.head_tail_split(df, 60, 40)
    counts = {r["split"]: r["count"] for r in s.groupBy("split").count().collect()}
    assert counts == {"train": 60, "valid": 40}
    assert s.select("id").distinct().count() == 100
    with pytest.raises(ValueError):
        split.head_tail_split(df, 70, 40)
    both = split.head_tail_split(df, 70, 40, allow_overlap=True)
    assert both.count() == 110
    head = {r.id for r in split.head(df, 70).collect()}
    assert {r.id for r in both.where(F.col("split") == "train").collect()} == head


def test_prefix_near_whole_table_falls_back_exactly(spark):
    df = spark.range(3000).select((F.col("id") * 11 % 3001).alias("id"))
    want = sorted(r.id for r in df.orderBy("id").limit(2950).collect())
    assert sorted(r.id for r in split.prefix(df, 2950).collect()) == want
    assert split.prefix(df, 5000).count() == 3000
