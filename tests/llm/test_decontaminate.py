import random

from hypothesis import given, settings
from hypothesis import strategies as st

from corpora import WORDS
from fixture_paths import SF_SMALL
from tabspark.llm import decontaminate as D
from tabspark.llm.q_decontaminate import op7_latent_decontamination

VOCABULARY = [a + b for a in WORDS for b in WORDS]


def prose(rng, n):
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(max(row[j] + (x == y), row[j + 1], new[-1]))
        row = new
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=15), st.lists(st.integers(0, 4), max_size=15))
def test_lcs(a, b):
    assert D.lcs_length(len(a), D.places(a), b) == lcs(a, b)


def paraphrase(rng, text, share):
    words = text.split()
    for i in rng.sample(range(len(words)), int(share * len(words))):
        words[i] = rng.choice(VOCABULARY)
    return " ".join(words)


def setting(spark):
    rng = random.Random(0)
    items = [f"{prose(rng, rng.randint(14, 40))}. {prose(rng, 6)}." for _ in range(30)]
    bench = [(i, t) for i, t in enumerate(items)] + [(100, None), (101, ""), (102, "too short"), (0, items[0])]
    docs, want = [], {}
    for i in range(120):
        text = prose(rng, rng.randint(0, 150))
        if i % 4 == 1:
            text = f"{text} {items[i % 30]} {prose(rng, 60)}"
            want[i] = i % 30
        if i % 12 == 2:
            text = f"{text} {paraphrase(rng, items[i % 30], 0.2).upper()} {prose(rng, 60)}"
            want[i] = i % 30
        docs.append((i, text))
    docs += [(500, None), (501, ""), (502, prose(rng, 30_000) + " " + items[3]), (503, items[4]), (None, items[5]), (1, docs[1][1])]
    want |= {502: 3, 503: 4, None: 5}
    return spark.createDataFrame(bench, "item_id long, text string"), docs, want


def test_leaks(spark, make_docs):
    bench, rows, want = setting(spark)
    docs = make_docs(rows, extra=True)
    found = D.leaks(docs, bench).collect()
    assert {(r.doc_id, r.item_id) for r in found} == set(want.items())
    assert all(r.kind == "copy" and r.coverage == 1 for r in found if r.doc_id in (502, 503, None))
    kept = D.remove_leaked(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(k for k, _ in rows if k not in want)


def test_slices_of_a_large_benchmark(spark, make_docs, monkeypatch):
    bench, rows, want = setting(spark)
    monkeypatch.setattr(D.item_slices, "__defaults__", (300,))
    docs = make_docs(rows)
    assert {(r.doc_id, r.item_id) for r in D.leaks(docs, bench).collect()} == set(want.items())


def test_answer_check(spark, make_docs):
    rng = random.Random(9)
    body, answer = prose(rng, 30), prose(rng, 8)
    bench = spark.createDataFrame([(0, f"{body}. {answer}.")] + [(i, prose(rng, 35)) for i in range(1, 40)],
                                  "item_id long, text string")
    other = f"{prose(rng, 50)} {paraphrase(rng, body, 0.1)} {prose(rng, 50)}"  # most of the item, but not its answer
    whole = f"{prose(rng, 50)} {paraphrase(rng, body, 0.3)}. {answer}. {prose(rng, 50)}"
    got = {r.doc_id: r.kind for r in D.leaks(make_docs([other, whole] + [prose(rng, 80) for _ in range(150)]), bench).collect()}
    assert got == {1: "paraphrase"}


def test_rows_are_judged_where_they_lie(spark, make_docs):
    rng = random.Random(11)
    items = [prose(rng, 30) for _ in range(8)] + ["short unlikely phrase", "..."]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    clean = [prose(rng, 60) for _ in range(40)]
    rows = [(None, items[2]), (None, clean[0]), (5, items[3]), (5, clean[1]), (7, None),
            (8, f"{clean[2]} Short, unlikely phrase! {clean[3]} {items[4]}"), (9, "short unlikely"), (10, "unlikely phrase short unlikely")]
    rows += [(20 + i, t) for i, t in enumerate(clean)]
    got = D.judged(make_docs(rows, extra=True), bench)
    assert got.columns == ["doc_id", "leaked", "item_id", "coverage", "kind", "n_items"]
    found = sorted([tuple(r) for r in got.collect() if r.leaked], key=repr)
    assert found == sorted([(None, True, 2, 1.0, "copy", 1), (5, True, 3, 1.0, "copy", 1), (8, True, 4, 1.0, "copy", 2)], key=repr)
    assert got.count() == len(rows)
    kept = D.remove_leaked(make_docs(rows), bench)
    assert kept.count() == len(rows) - 3 and kept.where("doc_id = 5").count() == 1
    only = bench.where("item_id >= 8")  # short items alone need no space
    assert [r.doc_id for r in D.judged(make_docs(rows), only).where("leaked").collect()] == [8]


def test_query_function(spark):
    got = op7_latent_decontamination(spark, SF_SMALL)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    bench = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    pairs = {(r.doc_id, r.item_id) for r in D.leaks(docs, bench).collect()}
    rows = got.collect()
    assert len(rows) == docs.count() and {r.doc_id for r in rows if r.leaked} == {d for d, _ in pairs}
    assert all((r.doc_id, r.item_id) in pairs for r in rows if r.leaked) and all(r.item_id is None for r in rows if not r.leaked)


def test_empty_tables(spark, make_docs):
    bench, rows, _ = setting(spark)
    assert D.leaks(make_docs([]), bench).count() == 0 and D.remove_leaked(make_docs([]), bench).count() == 0
    docs = make_docs(rows)
    assert D.leaks(docs, bench.limit(0)).count() == 0 and D.remove_leaked(docs, bench.limit(0)).count() == len(rows)


def test_frequent_items_and_tiny_tables(spark, make_docs):
    rng = random.Random(5)
    items = [f"{prose(rng, 24)}. {prose(rng, 6)}." for _ in range(30)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    found = lambda rows: {(r.doc_id, r.item_id) for r in D.leaks(make_docs(rows), bench).collect()}
    assert found([items[3]]) == {(0, 3)}  # a table of one document, equal to one item
    rows = [f"{prose(rng, 40)} {items[7] if i % 3 == 0 else prose(rng, 30)} {prose(rng, 30)}" for i in range(300)]
    assert found(rows) == {(i, 7) for i in range(0, 300, 3)}  # an item in a third of all rows
    near = [f"{prose(rng, 40)} {paraphrase(rng, items[7], 0.15) if i % 3 == 0 else ''} {prose(rng, 60)}" for i in range(300)]
    assert {i for i, _ in found(near)} <= set(range(0, 300, 3)) and len(found(near)) > 90


def test_every_stretch_with_the_share_is_a_candidate():
    rng, few = random.Random(6), [a + b for a in WORDS[:4] for b in WORDS[:4]]  # words that are frequent everywhere
    items = D.items_of([(i, " ".join(rng.choice(few) for _ in range(rng.randint(8, 40)))) for i in range(40)], 8)
    texts = [" ".join(rng.choice(few) for _ in range(rng.randint(0, 120))) for _ in range(200)]
    words = D.Words(D.pa.array(texts))
    column = items.columns(words.hash)
    row, first = D.steps(D.np.diff(words.first), D.STEP)
    step = first[words.row] + (D.np.arange(len(column)) - words.first[words.row]) // D.STEP
    df = D.np.bincount(column[column >= 0], minlength=len(items.vocabulary))
    met = 0
    for w in items.words:
        rare = D.rare_words(items.columns(w), df, len(row), 0.6)
        at = D.holding(rare, step[D.np.isin(column, rare.words)], row, first)
        for r in range(len(texts)):
            here = words.hash[words.first[r]:words.first[r + 1]].tolist()
            width = D.stretch(len(w))
            if any(lcs(w.tolist(), here[s:s + width]) >= 0.6 * len(w) for s in range(max(1, len(here) - width + 1))):
                met += 1
                assert r in row[at]
    assert met > 20
