import random

import numpy as np
import pyarrow as pa

from pyspark.sql import functions as F

from corpora import prose
from fixture_paths import SF_ORACLE
from tabspark.llm import quality
from tabspark.llm.q_quality import op6_co_training


def corpus(n=300):
    rng = random.Random(0)
    rows, labels = [], []
    for i in range(n):
        good = i % 3 != 0
        t = prose(rng, rng.randint(20, 90)) + "."
        rows.append((i, t if good else rng.choice([t.upper().replace(" ", "!! "), t.replace(" ", "*** "), "word " * 30])))
        labels.append((i, int(good)))
    return rows, labels


def test_held_out_accuracy(spark, make_docs):
    rows, labels = corpus()
    extra = [(900, None), (901, ""), (902, "x " * 100_000), (None, "null id"), (1, rows[1][1])]
    docs = make_docs(rows + extra, extra=True)
    seen = spark.createDataFrame([(i, y) for i, y in labels if i % 4] + [(None, 1), (2, None), (3, 9)], "doc_id long, quality int")
    got = quality.co_train(docs, seen, per_round=20).collect()
    assert len(got) == len(rows) + len(extra) and all(0 <= r.score <= 1 for r in got)
    held = [(r.score >= 0.5) == (r.id % 3 != 0) for r in got if r.id is not None and r.id < 300 and r.id % 4 == 0]
    assert np.mean(held) > 0.95
    twice = [r.score for r in got if r.id == 1]
    assert len(twice) == 2 and abs(twice[0] - twice[1]) < 0.2


def test_one_class_no_labels_empty_table(spark, make_docs):
    schema = "doc_id long, quality int"
    docs = make_docs(["a b c", None])
    assert {r.score for r in quality.co_train(docs, spark.createDataFrame([], schema)).collect()} == {0.5}
    assert {r.score for r in quality.co_train(docs, spark.createDataFrame([(0, 1), (1, 1)], schema)).collect()} == {1.0}
    assert quality.co_train(make_docs([]), spark.createDataFrame([(0, 1)], schema)).count() == 0


def test_features_of_odd_texts():
    x = quality.text_features(pa.array([None, "", "A", "ÀÉ " * 1000, "a\n" * 10, "!!!"]))
    assert x.shape[0] == 6 and np.isfinite(x).all() and (x[0] == x[1]).all()
    assert quality.text_features(pa.array([], pa.string())).shape[0] == 0


def test_line_features_tell_noise_apart():
    clean, shout, marked, copied = quality.text_features(
        pa.array(["the river ran on.", "THE!! RIVER!! RAN!! ON!!", "the*** river### ran%%% on&&&", "the the the the the"]))
    assert shout[2] > clean[2] and marked[7] > clean[7] and copied[12] > clean[12]


def test_copies_are_one_pseudo_label(spark, make_docs):
    """The rows of a round are the surest different ones: a third of all documents being one text changes nothing."""
    rows, _ = corpus(60)
    docs = make_docs(rows + [(1000 + i, rows[0][1]) for i in range(40)]).withColumn("lang", F.lit("en")).withColumn("source", F.lit("s"))
    own = quality.features(docs, "doc_id", "text", "lang", "source", "n_chars")
    kinds = {r.id: r.kind for r in own.collect()}
    assert len({kinds[1000 + i] for i in range(40)} | {kinds[0]}) == 1
    others = own.groupBy("kind").agg(*[F.first(v).alias(v) for v in quality.VIEWS])
    model = quality.fit_view(own.join(spark.createDataFrame([(i, float(i % 3 != 0)) for i in range(30)], "id long, label double"), "id"), "text_view")
    scored = quality.logit_of(model, others, "text_view")
    z = sorted((r.text_view_z for r in scored.collect()), reverse=True)
    got = quality.logit_of(model, quality.surest(scored, "text_view", 1, 0.0, 10), "text_view").collect()
    assert sorted((r.text_view_z for r in got), reverse=True) == [x for x in z if x >= 0][:10] and all(r.label == 1 for r in got)


def test_query_function(spark):
    import zlib

    got = op6_co_training(spark, SF_ORACLE).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_ORACLE}/labels.parquet").collect()}
    assert len(got) == spark.read.parquet(f"{SF_ORACLE}/documents.parquet").count()
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.5)
    held = [r.predicted == labels[r.doc_id] for r in got if r.held_out and labels.get(r.doc_id) in (0, 1)]
    assert np.mean(held) > 0.9
