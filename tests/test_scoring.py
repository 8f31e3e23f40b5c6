"""Kept pipelines: the same scores after reloading in another session, and a check of the input columns."""

import os
import subprocess
import sys

import pytest
from pyspark.ml.feature import MinMaxScaler, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tabspark.operators import scoring

def stages():
    return (VectorAssembler(inputCols=["a", "b"], outputCol="raw"), MinMaxScaler(inputCol="raw", outputCol="features"),
            LinearRegression(featuresCol="features", labelCol="y", solver="normal"))


def frame(spark):
    return spark.createDataFrame([(i, float(i), float(i * i % 17), 3.0 * i - i * i % 17 + 1) for i in range(50)],
                                 "id long, a double, b double, y double")


def test_scores_survive_a_reload(spark, tmp_path):
    df, path = frame(spark), str(tmp_path / "kept")
    model = scoring.fit_and_keep(df, stages(), ["a", "b", "y"], path)
    want = {r.id: r.prediction for r in model.transform(df).collect()}
    assert {r.id: r.prediction for r in scoring.score(spark, path, df).collect()} == want
    more = scoring.score(spark, path, df.drop("y").withColumn("other", F.lit("x")), optional=["y"])
    assert {r.id: r.prediction for r in more.collect()} == want and "other" in more.columns


def test_another_session_scores_alike(spark, tmp_path):
    df, path, data = frame(spark), str(tmp_path / "kept"), str(tmp_path / "data")
    model = scoring.fit_and_keep(df, stages(), ["a", "b", "y"], path)
    df.write.parquet(data)
    code = ("from tabspark.session import local_session\nfrom tabspark.operators import scoring\n"
            "s = local_session(cores=2, shuffle_partitions=2)\n"
            f"print('SUM', scoring.score(s, {path!r}, s.read.parquet({data!r})).selectExpr('sum(prediction * (id + 1))').first()[0])\n")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120,
                         env=os.environ | {"PYTHONPATH": root, "TABSPARK_DRIVER_MEMORY": "1g"}).stdout
    got = float(next(x for x in out.splitlines() if x.startswith("SUM")).split()[1])
    assert got == pytest.approx(model.transform(df).selectExpr("sum(prediction * (id + 1))").first()[0], rel=1e-12)


def test_other_columns_raise(spark, tmp_path):
    df, path = frame(spark), str(tmp_path / "kept")
    scoring.fit_and_keep(df, stages(), ["a", "b", "y"], path)
    with pytest.raises(scoring.SchemaMismatch, match="b: double expected, nothing found"):
        scoring.score(spark, path, df.drop("b"))
    with pytest.raises(scoring.SchemaMismatch, match="a: double expected, string found"):
        scoring.score(spark, path, df.withColumn("a", F.col("a").cast("string")))
