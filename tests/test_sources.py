"""Readers and sinks on files made from the driver tables."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tabspark.operators import fit
from tabspark.sources import sinks, tables, views

from fixture_paths import SF_SMALL


def _tmp():
    return tempfile.mkdtemp(prefix="tabspark-test-")


def test_delimited_with_schema(spark):
    e = views.ex(spark, SF_SMALL).select("id", "gross", "net_k")
    path = os.path.join(_tmp(), "ex_csv")
    e.write.option("header", True).csv(path)
    back = tables.read_delimited(spark, path, tables.numeric_schema(["id", "gross", "net_k"]))
    assert back.count() == e.count()
    assert dict(back.dtypes)["gross"] == "double"
    got = back.agg(F.sum("gross")).first()[0]
    want = e.agg(F.sum("gross")).first()[0]
    assert abs(got - want) < 1e-6 * abs(want)


def test_delimited_columns_are_found_by_name(spark):
    path = os.path.join(_tmp(), "swapped.csv")
    with open(path, "w") as f:
        f.write("b,a,c\n1,2,x\n3,4,y\n")
    rows = tables.read_delimited(spark, path, "a double, b double").orderBy("a").collect()
    assert [(r.a, r.b) for r in rows] == [(2.0, 1.0), (4.0, 3.0)]
    with pytest.raises(ValueError):
        tables.read_delimited(spark, path, "a double, d double")


def test_delimited_files_of_another_order_raise(spark):
    path = _tmp()
    for name, head in (("1.csv", "a,b"), ("2.csv", "b,a")):
        with open(os.path.join(path, name), "w") as f:
            f.write(head + "\n1,2\n")
    with pytest.raises(Exception, match="header|Header"):
        tables.read_delimited(spark, path, "a double, b double").collect()


def test_headerless_ids_do_not_depend_on_splits(spark):
    path = os.path.join(_tmp(), "v.csv")
    with open(path, "w") as f:
        f.write("".join(f"{i % 5},{i % 7},{i % 3}\n" for i in range(4000)))
    ids = []
    for size in ("134217728", "2000"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        ids.append(sorted(r.id for r in tables.read_headerless_vectors(spark, path, 2).select("id").collect()))
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert ids[0] == ids[1] and len(set(ids[0])) == 4000


def test_headerless_vectors(spark):
    emb = tables.read_table(spark, SF_SMALL, "embeddings")
    flat = emb.select(F.col("label").cast("double").alias("c0"),
                      *[F.col("embedding")[i].cast("double").alias(f"c{i + 1}") for i in range(64)])
    path = os.path.join(_tmp(), "digits_csv")
    flat.write.option("header", False).csv(path)
    v = tables.read_headerless_vectors(spark, path, 64)
    row = v.first()
    assert len(row["v"]) == 64 and 0 <= row["label"] <= 9
    assert v.select("id").distinct().count() == emb.count()


def test_vocabulary_file(spark):
    path = os.path.join(_tmp(), "vocab.txt")
    with open(path, "w") as f:
        f.write("good bad  good\nfilm movie\n\nbad\n")
    terms = sorted(r.term for r in tables.read_vocabulary_file(spark, path).collect())
    assert terms == ["bad", "film", "good", "movie"]


def test_metrics_sink_roundtrip(spark):
    path = os.path.join(_tmp(), "metrics")
    m = spark.createDataFrame([(0, "train", "rmse", 1.5), (1, "train", "rmse", 1.2)],
                              "period long, split string, metric string, value double")
    sinks.append_metrics(m, path, "a")
    sinks.append_metrics(m, path, "b")
    sinks.append_metrics(m, path, "a")  # a repeated run replaces itself
    back = spark.read.parquet(path)
    assert back.count() == 4 and sorted(r.run for r in back.select("run").distinct().collect()) == ["a", "b"]


def test_warm_restart_equals_longer_run(spark):
    df = spark.createDataFrame([(float(i) / 50, 3.0 * i / 50 - 1.0, "train") for i in range(50)],
                               "x double, y double, split string")
    full = fit.gradient_descent(df, ["x"], "y", lr=0.3, steps=6, checkpoint=False)
    first = fit.gradient_descent(df, ["x"], "y", lr=0.3, steps=3, checkpoint=False)
    second = fit.gradient_descent(df, ["x"], "y", lr=0.3, steps=3, checkpoint=False,
                                  init=(first.weights, first.bias))
    assert abs(full.weights[0] - second.weights[0]) < 1e-12 and abs(full.bias - second.bias) < 1e-12
