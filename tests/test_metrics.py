"""Metric operators on hand-made rows and properties."""

import math

from pyspark.sql import functions as F

from tabspark.operators import evaluate, profile


def test_auc_hand_example(spark):
    df = spark.createDataFrame([(0.0, 0.1), (0.0, 0.4), (1.0, 0.35), (1.0, 0.8)], "label double, p double")
    assert evaluate.auc(df, "p", "label").first()["auc"] == 0.75
    eq = spark.createDataFrame([(0.0, 0.5), (0.0, 0.5), (1.0, 0.5), (1.0, 0.5)], "label double, p double")
    assert evaluate.auc(eq, "p", "label").first()["auc"] == 0.5


def test_auc_flip_symmetry(spark):
    rows = [(float(i % 2), ((i * 37) % 101) / 101.0) for i in range(500)]
    df = spark.createDataFrame(rows, "label double, p double")
    a = evaluate.auc(df, "p", "label").first()["auc"]
    b = evaluate.auc(df.withColumn("p", -F.col("p")), "p", "label").first()["auc"]
    assert abs(a + b - 1.0) < 1e-12


def test_roc_endpoints(spark):
    df = spark.createDataFrame([(0.0, 0.1), (0.0, 0.4), (1.0, 0.35), (1.0, 0.8)], "label double, p double")
    pts = sorted((r["fpr"], r["tpr"]) for r in evaluate.roc_curve(df, "p", "label").collect())
    assert pts[0] == (0.0, 0.0) and pts[-1] == (1.0, 1.0) and len(pts) == 5


def test_confusion_normalised_empty_class(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1)], "y long, p long")
    cm = evaluate.confusion_matrix(df, "y", "p", 3)
    assert cm.agg(F.sum("n")).first()[0] == 3
    rows = {(r["label"], r["predicted"]): r["share"] for r in evaluate.confusion_normalised(cm).collect()}
    assert rows[(0, 0)] == 0.5 and rows[(0, 1)] == 0.5 and rows[(1, 1)] == 1.0
    assert rows[(2, 0)] is None and rows[(2, 2)] is None


def test_log_loss_hard_vs_soft(spark):
    df = spark.createDataFrame([(0, [0.9, 0.1]), (1, [0.8, 0.2])], "label int, p array<double>")
    soft = evaluate.log_loss_multi(df, "p", "label", "soft").first()["log_loss"]
    hard = evaluate.log_loss_multi(df, "p", "label", "hard").first()["log_loss"]
    assert abs(soft - (-(math.log(0.9) + math.log(0.2)) / 2)) < 1e-12
    assert abs(hard - (-math.log(1e-15) / 2)) < 1e-6


def test_histogram_covers_all_rows(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 1, 2, 3, 9.5, 10]], "x double")
    h = profile.histogram(df, "x", 10).orderBy("bin").collect()
    assert len(h) == 10 and sum(r["n"] for r in h) == 6 and h[-1]["n"] == 2


def test_quantile_hand_example(spark):
    from tabspark.operators import encode

    df = spark.createDataFrame([(float(v),) for v in range(1, 10)], "x double")
    q4 = [r["value"] for r in encode.quantiles(df, ["x"], encode.probs_i_over_n(4)).orderBy("idx").collect()]
    assert q4 == [3.0, 5.0, 7.0]
    q4b = [r["value"] for r in encode.quantiles(df, ["x"], encode.probs_i_over_n_plus_1(4)).orderBy("idx").collect()]
    assert [round(v, 10) for v in q4b] == [2.6, 4.2, 5.8, 7.4]


def test_corr_does_not_depend_on_other_columns(spark):
    rows = [tuple((float(i * (j + 3) % 17) if j or i % 3 else None) for j in range(25)) for i in range(120)]
    cols = [f"c{j}" for j in range(25)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols))
    got = [{(r.col_a, r.col_b): r.r for r in profile.corr_matrix(df, cols[:n]).collect()} for n in (24, 25)]
    assert all(got[0][k] == got[1][k] for k in got[0]) and len(got[1]) == 625


def test_auc_of_very_many_rows(spark):
    from tabspark.operators import evaluate, ordering  # noqa: F401

    counts = spark.createDataFrame([(0.1, 0, 4_000_000_000), (0.5, 1_000_000_000, 1), (0.9, 4_000_000_000, 0)],
                                   "score double, pos long, neg long")
    cum = ordering.running_sum_by_value(counts, "score", ["neg"])
    assert evaluate.area(cum).first()["auc"] > 0.999999


def test_approx_quantiles_within_rank_error(spark):
    import numpy as np

    from tabspark.operators import encode

    xs = [float((i * 37) % 1009) for i in range(5000)]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    probs = encode.probs_i_over_n(7)
    got = [r["value"] for r in encode.quantiles(df, ["x"], probs, approx=True).orderBy("idx").collect()]
    srt = np.sort(xs)
    for p, v in zip(probs, got):
        rank = np.searchsorted(srt, v, side="right") / len(xs)
        assert abs(rank - p) < 0.01
