import random

from corpora import prose
from tabspark.llm import toxicity


def test_folding():
    assert toxicity.fold("1d1ot! ѕtupid s.t.u.p.i.d i d i o t stuuupid ｉｄｉｏｔ l0ser$ don't 2023") == \
        "idiot stupid stupid idiot stuupid idiot loser dont 2023"


def test_exception_phrases_and_length():
    lex = toxicity.Lexicon({"trash": 5.0, "lowe*": 4.0})
    a = lex.automaton()
    assert toxicity.matched(toxicity.fold("a trash can and tr4sh"), a) == (1, 5.0)
    assert toxicity.matched(toxicity.fold("loweisch lowe low"), a) == (2, 8.0)
    assert toxicity.normalised(5, 1000) < toxicity.normalised(5, 10)
    assert toxicity.matched("", a) == (0, 0.0) and toxicity.matched("x", None) == (0, 0.0)


def corpus(seed=0, n=240):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = prose(rng, rng.randint(20, 120)).split()
        toxic = i % 4 == 0
        for _ in range(3 if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(["scumbag", "dimwit", "numskull"]))
        rows.append((" ".join(words), int(toxic)))
    return rows


def test_learned_lexicon_separates(spark, make_docs):
    rows = corpus()
    lex = toxicity.learn(spark.createDataFrame(rows, "text string, toxic int").repartition(4))
    assert set(lex.weights) == {"scumbag", "dimwit", "numskull"}
    fresh = corpus(1, 80) + [("You d1mw1t, you ѕcumbag and num-skull " + rows[1][0], 1)]
    docs = make_docs([t for t, _ in fresh] + [None, "", "x " * 100_000, (None, "dimwit dimwit dimwit"), (0, fresh[0][0])], extra=True)
    got = toxicity.measure(docs, lex, "doc_id").collect()
    assert len(got) == len(fresh) + 5
    score = {}
    for r in got:
        assert 0 <= r.score <= 1 and score.setdefault(r.doc_id, r.score) == r.score
    assert [int(score[i] >= 0.5) for i in range(len(fresh))] == [y for _, y in fresh]
    assert all(score[len(fresh) + k] < 0.5 for k in range(3)) and score[None] >= 0.5
    kept = toxicity.keep_clean(docs, lex)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.score < 0.5 for r in got)


def test_copies_count_once(spark):
    rng = random.Random(2)
    odd = "zzyzx " + prose(rng, 40)
    rows = corpus() + [(odd, 1)] * 30
    assert "zzyzx" not in toxicity.learn(spark.createDataFrame(rows, "text string, toxic int")).weights


def test_exceptions_are_learned(spark):
    rng = random.Random(5)
    rows = corpus() + [(f"{prose(rng, 30)} dimwit award {prose(rng, 10)}", 0) for _ in range(10)]
    lex = toxicity.learn(spark.createDataFrame(rows, "text string, toxic int"), min_log_odds=1.0)
    assert "dimwit award" in lex.exceptions


def test_one_class_nulls_and_empty(spark, make_docs):
    learn = lambda rows: toxicity.learn(spark.createDataFrame(rows, "text string, toxic int"))
    for rows, score in (([], 0.0), ([("a", 0)], 0.0), ([("a", 1), (None, None), ("b", 7)], 1.0)):
        got = toxicity.measure(make_docs(["a", None]), learn(rows), "doc_id").collect()
        assert all(abs(r.score - score) < 1e-6 for r in got)
    assert toxicity.measure(make_docs([]), toxicity.Lexicon(), "doc_id").count() == 0


def test_logistic_recovers_a_line():
    import math
    points = [(x / 4, y, round(1e4 * (p if y else 1 - p))) for x in range(-12, 13)
              for p in [1 / (1 + math.exp(-(2 * x / 4 - 1)))] for y in (0, 1)]
    a, b = toxicity.logistic(points)
    assert abs(a - 2) < 0.02 and abs(b + 1) < 0.02
