"""Term vectors over the whole vocabulary, and a classifier on documents' mean vectors."""

import random

from tabspark.operators import term_factors


def corpus(spark, n=160):
    rng = random.Random(1)
    topics = [[f"{t}{i}" for i in range(40)] for t in "ab"]
    rows = [(i, [rng.choice(topics[i % 2]) for _ in range(20)] + ["common"] * 3, float(i % 2)) for i in range(n)]
    return spark.createDataFrame(rows, "id long, terms array<string>, label double").repartition(3)


def test_every_training_term_has_a_vector(spark):
    df = corpus(spark)
    got = term_factors.fit(df.where("id < 120"), rank=4, iterations=4)
    want = {t for r in df.where("id < 120").collect() for t in r.terms}
    rows = got.terms.collect()
    assert {r.term for r in rows} == want and len(rows) == len(want) and all(len(r.vector) == 4 for r in rows)


def test_held_out_accuracy(spark):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.sql import functions as F

    df = corpus(spark)
    factors = term_factors.fit(df.where("id < 120"), rank=4, iterations=6)
    data = term_factors.as_features(factors.embed(df))
    m = LogisticRegression().fit(data.where("id < 120"))
    held = m.transform(data.where("id >= 120")).agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
    assert held > 0.95


def test_unknown_terms_nulls_and_empty_tables(spark):
    df = corpus(spark, 40)
    factors = term_factors.fit(df, rank=3, iterations=2)
    odd = spark.createDataFrame([(1, None, 0.0), (2, [], 0.0), (3, ["unseen"], 0.0), (4, ["a1", "a1", "unseen"], 0.0)],
                                "id long, terms array<string>, label double")
    got = {r.id: r.vector for r in factors.embed(odd).collect()}
    own = {r.term: r.vector for r in factors.terms.collect()}["a1"]
    assert got[1] == got[2] == got[3] == [0.0] * 3 and got[4] == [float(x) for x in own]
    empty = term_factors.fit(odd.where("id < 3"), rank=3)
    assert empty.terms.count() == 0 and empty.embed(odd).where("vector[0] = 0").count() == 4


def test_documents_are_numbered_by_rows_of_their_own(spark, monkeypatch):
    """Numbering reads a row per document, not one per document and term; repeated rows, null terms and null ids count once."""
    given, number = {}, term_factors.numbered

    def watched(values, col):
        given[col] = values.count()
        return number(values, col)

    monkeypatch.setattr(term_factors, "numbered", watched)
    rows = [(1, ["a", "b", "a"]), (1, ["a", "b", "a"]), (2, ["b", "c", None]), (3, [None]), (4, []), (5, None), (None, ["d", "e"])]
    df = spark.createDataFrame(rows, "id long, terms array<string>").repartition(2)
    got = term_factors.fit(df, rank=2, iterations=2)
    assert given["_doc"] == 4
    assert {r.term for r in got.terms.collect()} == {"a", "b", "c"}
