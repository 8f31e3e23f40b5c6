import hashlib

import pytest
from pyspark.sql import functions as F

from tabspark.llm import fill_middle
from tabspark.llm.q_fill_middle import SQL, op12_fill_middle
from tabspark.plans.oracle_check import compare

from corpora import prose
from fixture_paths import SF_SMALL


def brute(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    n = len(text)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}"
    return n, "psm", a, b - a, f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}"


def test_equals_brute_force_and_round_trip(spark, make_docs):
    import random

    rng = random.Random(3)
    odd = [None, "", "a", "\n", "\r\n x\u0085", "é\U0001F926\U0001F3FC‍♂️" * 40, "a\x00b", "<P", "<<S", "x<P>y",
           "<S>", "tail <M>", "<P <S <M >", ">S>M>", "中文" * 50, " " * 300, prose(rng, 60_000)]
    texts = odd * 12 + [prose(rng, rng.randint(1, 40)) + rng.choice(["", "<", "<S", ">"]) for _ in range(300)]
    rows = list(enumerate(texts)) + [(None, "no id"), (None, None), (5, "again"), (5, "again"), (-3, "minus")]
    docs = make_docs(rows, extra=True).withColumn("output", F.lit(1)).withColumn("form", F.lit(2))
    done = fill_middle.transform(docs).withColumn("back", fill_middle.restore("output", "form"))
    got = sorted([tuple(r) for r in done.collect()], key=repr)
    assert got == sorted([(i, *brute(i, t), t or "") for i, t in rows], key=repr)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


def test_other_units_and_markers(spark, make_docs):
    marks = fill_middle.Markers("<|prefix|>", "<|suffix|>", "<|middle|>")
    family = "\U0001F468‍\U0001F469‍\U0001F467"
    docs = make_docs([family * 30, "é" * 50, "plain <|suffix|>"])
    done = fill_middle.transform(docs, marks=marks, unit=r"\X", plain_from=100)
    got = {r.doc_id: r for r in done.withColumn("back", fill_middle.restore("output", "form", marks)).collect()}
    assert (got[0].n, got[1].n, got[2].form) == (30, 50, "plain")
    assert got[0].prefix_chars % 5 == 0 and got[0].middle_chars % 5 == 0 and got[1].prefix_chars % 2 == 0
    assert [got[i].back for i in range(3)] == [family * 30, "é" * 50, "plain <|suffix|>"]


def test_a_unit_that_leaves_text_out_is_an_error(spark, make_docs):
    with pytest.raises(Exception, match="does not match every part"):
        fill_middle.transform(make_docs(["a\nb"]), unit=".").collect()


def test_empty_table(spark, make_docs):
    done = fill_middle.transform(make_docs(["x"]).limit(0))
    assert done.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"] and done.count() == 0


def test_query_and_sql(spark):
    r = compare(spark, SF_SMALL, "op12", op12_fill_middle, SQL["op12_fill_middle"])
    assert r["rows_match"] and r["schema_match"] and r["hash_match"], r
