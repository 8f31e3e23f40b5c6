"""Documents as blocks of term counts, and what is learned from them block by block."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabspark.operators import term_blocks, term_factors

ROWS = [(1, ["a", "b", "a"], "train"), (1, ["b", "c"], "train"), (2, ["b", "c", None], "train"), (3, [None], "train"), (4, [], "train"),
        (5, None, "train"), (6, ["c", "é", "c", "c"], "valid"), (7, ["zz"], "valid"), (None, ["a"], "train")] + [
        (i, [f"t{i % 7}", "a", f"t{i}"], "train" if i % 3 else "valid") for i in range(10, 40)]


@pytest.fixture(autouse=True)
def small_batches(spark):
    """Blocks end between batches: of four rows here."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    yield
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def frame(spark):
    return spark.createDataFrame(ROWS, "id long, terms array<string>, split string").repartition(3)


def test_blocks_hold_every_document_and_count(spark):
    """Several blocks a task; each document's terms and counts come back, each term's string once a block."""
    blocks = term_blocks.build(frame(spark), keep=("id", "split"), cells=5).collect()
    assert len(blocks) > 3 and len({b.block for b in blocks}) == len(blocks)
    got = Counter()
    for b in blocks:
        assert len(set(b.terms)) == len(b.terms)
        ids = np.frombuffer(b.ids, np.int32)
        lengths, counts, at = b.lengths, term_blocks.unpacked(b.counts, len(ids)), 0
        for key, s, n in zip(b.id, b.split, lengths, strict=True):
            got[key, s, frozenset((b.terms[i], int(c)) for i, c in zip(ids[at:at + n], counts[at:at + n]))] += 1
            at += n
        assert at == len(ids)
    want = Counter((k, s, frozenset(Counter(t for t in terms or () if t is not None).items())) for k, terms, s in ROWS)
    assert got == want


def test_terms_of_some_documents(spark):
    blocks = term_blocks.build(frame(spark), keep=("id", "split"), cells=5)
    got = {r.term for r in term_blocks.terms_in(blocks, F.transform("split", lambda s: s == "train").alias("use")).collect()}
    assert got == {t for _, terms, s in ROWS if s == "train" for t in terms or () if t is not None}


def test_als_blocks_grow_with_the_cells(spark, monkeypatch):
    """A task of the fit holds a block: there are as many as keep one's cells within the limit, 10 at least as before."""
    seen, als = [], term_factors.ALS
    monkeypatch.setattr(term_factors, "ALS", lambda **k: seen.append((k["numUserBlocks"], k["numItemBlocks"])) or als(**k))
    df = frame(spark)
    few = term_factors.fit(df, rank=2, iterations=1)
    monkeypatch.setattr(term_factors, "ALS_CELLS", 4)
    cells = {(k, t) for k, terms, _ in ROWS for t in terms or () if t is not None and k is not None}
    many = term_factors.fit(df, rank=2, iterations=1)
    assert seen == [(10, 10), (-(-len(cells | {(1, "b2")}) // 4),) * 2]
    assert {r.term for r in many.terms.collect()} == {r.term for r in few.terms.collect()} == {t for _, t in cells}


def test_counts_of_a_repeated_key_are_added(spark, monkeypatch):
    """ALS sees one cell per document and term, though the document's rows are dealt to several blocks."""
    seen, als = [], term_factors.ALS

    class Watched:
        def __init__(self, **k):
            self.own = als(**k)

        def fit(self, rows):
            seen.append(rows.collect())
            return self.own.fit(rows)

    monkeypatch.setattr(term_factors, "ALS", Watched)
    rows = [(1, ["a", "b", "a"]), (2, ["b"]), (1, ["a", "c"]), (1, ["a"])]
    term_factors.fit(spark.createDataFrame(rows, "id long, terms array<string>").repartition(3), rank=2, iterations=1)
    assert sorted(r.n for r in seen[0]) == [1, 1, 1, 4] and len({(r._row, r._no) for r in seen[0]}) == 4


def test_mean_vectors_by_block(spark, monkeypatch):
    """A row per document leaves the blocks, with sums; the means are those of the different known terms."""
    monkeypatch.setattr(term_blocks, "CELLS", 6)
    vectors = {"a": [1.0, 2.0], "c": [3.0, -1.0], "é": [0.5, 0.25], "t1": [8.0, 4.0]}
    factors = term_factors.TermFactors(spark.createDataFrame(list(vectors.items()), "term string, vector array<float>"), 2)
    hits, want = {}, {}
    for k, terms, _ in ROWS:
        if k is not None:
            hits.setdefault(k, []).extend(vectors[t] for t in set(terms or ()) if t in vectors)
    for k, v in hits.items():
        want[k] = [sum(x) / len(v) for x in zip(*v)] if v else [0.0, 0.0]
    df = frame(spark)
    for got in (factors.embed(df), factors.embed_blocks(term_blocks.build(df, keep=("id", "split"), cells=6), keep=("split",))):
        rows = got.collect()
        assert Counter((r.id, r.split) for r in rows) == Counter((k, s) for k, _, s in ROWS)
        assert all(r.vector == pytest.approx(want.get(r.id, [0.0, 0.0])) for r in rows)
