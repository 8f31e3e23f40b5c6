import random
import re
import time

import numpy as np
import pytest

from tabspark.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(text):
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in CARD.finditer(text):
        d = [int(c) for c in re.sub("[^0-9]", "", m[0])[::-1]]
        if 12 <= len(d) <= 19 and sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(d)) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return [(pii.KINDS[k], s, e) for s, k, e in sorted(out)]


def test_base_rules_equal_the_patterns():
    rng = random.Random(0)
    bits = ["a", "@", ".", "b", "1", "25", "5", "256", " ", "-", "+", "(", ")", "@", "é", "0", "4111111111111111", "99", "٣"]
    for _ in range(40_000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 25)))
        assert pii.base_spans(text) == brute(text), text


DOC = ("Call +1 (766) 555-2373 now. Later 766-555-2373 or 766 555 2373. Order 123456789. mail joe.x@site.example.com, "
       "joe.x at site.example.com and joe.x [at] site [dot] example.com")


def test_distant_mentions_agree():
    got = pii.fit([]).added(DOC, pii.base_spans(DOC))
    assert [(k, DOC[s:e]) for k, s, e in got] == [
        ("phone", "766-555-2373"), ("phone", "766 555 2373"),
        ("email", "joe.x at site.example.com"), ("email", "joe.x [at] site [dot] example.com")]
    alone = DOC.replace("+1 (766) 555-2373", "someone")
    assert not [x for x in pii.fit([]).added(alone, pii.base_spans(alone)) if x[0] == "phone"]


def test_messages_are_exact_on_a_tree():
    rng = np.random.default_rng(0)
    k = len(pii.LABELS)
    field = pii.Field(rng.normal(size=(pii.N_COLUMNS, k)), rng.normal(size=(k, k)), 1.3)
    g = pii.Graph([(i, i + 1) for i in range(4)], [[3], [9], [12], [40]], np.array([-1, 2, -1, -1]), [(0, 1), (1, 2), (2, 3)], [])
    want = np.zeros((4, k))
    for labels in np.ndindex(*(k,) * 4):
        if labels[1] == 2:
            w = np.exp(sum(field.node[g.features[i][0], labels[i]] for i in range(4) if i != 1)
                       + sum(field.chain[labels[i], labels[i + 1]] for i in range(3)))
            for i in range(4):
                want[i, labels[i]] += w
    assert np.allclose(field.beliefs(g, rounds=60, damping=0.0), want / want.sum(axis=1, keepdims=True), atol=1e-9)


@pytest.mark.parametrize("text", ["1" * 300_000, "a" * 300_000, "a@" * 100_000, "1.2.3." * 60_000, "+1 " * 100_000,
                                  " at " * 80_000, "a.b at " * 50_000, "1-" * 200_000, "+1(((" * 60_000, "5551234567 " * 2000])
def test_long_texts_take_linear_time(text):
    t = time.process_time()
    base = pii.base_spans(text)
    pii.graph(text, base)
    assert time.process_time() - t < 6


def test_find_and_redact(make_docs):
    texts = [DOC, None, "", "nothing here", "x " * 100_000 + "a@b.cd", DOC, "1.2.3.4 and 4111 1111 1111 1111", (None, "a@b.cd"), (0, "c@d.ef")]
    docs = make_docs(texts, extra=True)
    model = pii.train(docs)
    rows = pii.find(docs, model).collect()
    assert len(rows) == len(texts)
    joined = lambda spans: ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
    want = sorted(joined(brute((t[1] if isinstance(t, tuple) else t) or "")) for t in texts)
    assert sorted(r.base for r in rows) == want
    assert all(set(r.base.split(",")) <= set(r.spans.split(",")) for r in rows)
    out = pii.redact(docs, model)
    assert out.columns == docs.columns and out.count() == len(texts)
    got = {(r.doc_id, r.source): r.text for r in out.collect()}
    assert got[1, "s1"] is None and got[2, "s2"] == "" and got[3, "s3"] == "nothing here"
    assert got[6, "s6"] == "[IP] and [CARD]" and got[4, "s4"].endswith("x [EMAIL]")
    assert "example.com" not in got[5, "s5"] and "555" not in got[5, "s5"]


def test_empty_table(make_docs):
    docs = make_docs([])
    model = pii.train(docs)
    assert pii.find(docs, model).count() == 0 and pii.redact(docs, model).count() == 0


def test_overlapping_spans_are_redacted_once():
    assert pii.redact_text("ab1234cd", [("ip", 2, 5), ("card", 3, 6)]) == "ab[IP]cd"


def test_query_columns_follow_the_base_rules(spark):
    import hashlib

    from fixture_paths import SF_SMALL

    from tabspark.llm.q_pii import op5_skip_chain

    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = op5_skip_chain(spark, SF_SMALL).collect()
    assert len(got) == len(texts)
    for r in got:
        base = pii.base_spans(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for k, _, _ in base) for kind in ("email", "ip", "card", "phone")]
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(joined.split(",")) <= set(r.spans.split(",")) and len([x for x in r.spans.split(",") if x]) == len(base) + r.n_added


def test_training_is_the_same_however_rows_are_dealt(spark):
    texts = [f"call +1 555 010 {i:04} or mail a{i}@example.org, a{i} at example dot org" for i in range(60)]
    texts += [texts[0]] * 500  # copies count once
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    a, b = pii.train(df.repartition(1), max_train=20), pii.train(df.repartition(7), max_train=20)
    assert (a.node == b.node).all() and (a.chain == b.chain).all() and a.skip == b.skip
