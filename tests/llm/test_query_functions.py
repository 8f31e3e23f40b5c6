"""The registered queries of op1, op2, op3 and op9 over the whole small tables, against brute force."""

import zlib

import numpy as np

import test_exact_spans
import test_near_vectors
import test_packing
from fixture_paths import SF_ORACLE, SF_SMALL
from tabspark.llm import toxicity
from tabspark.llm.q_exact_spans import op2_suffix_array
from tabspark.llm.q_near_vectors import op9_epsilon_grid
from tabspark.llm.q_packing import op3_packing
from tabspark.llm.q_toxicity import op1_toxicity


def documents(spark, sf=SF_SMALL):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]


def test_op1(spark):
    got = op1_toxicity(spark, SF_ORACLE).collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF_ORACLE}/labels.parquet").collect()}
    assert sorted(r.doc_id for r in got) == sorted(k for k, _ in documents(spark, SF_ORACLE))
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [r.predicted == labels[r.doc_id] for r in got if r.held_out and labels.get(r.doc_id) in (0, 1)]
    assert len(held) > 50 and np.mean(held) > 0.97


def test_matches_equal_a_search_of_every_term(spark):
    """Aho-Corasick matching against looking for every form at every place."""
    lex = toxicity.Lexicon({"trash": 5.0, "lowe*": 4.0, "river": 1.5, "mirror": 2.0}, ("trash can", "river bank"))
    a = lex.automaton()
    for _, text in documents(spark)[:120] + [(0, "A trash can, tr4sh; RIVER bank river loweisch lower low mirror mirrors")]:
        folded = f" {toxicity.fold(text or '')} "
        forms = {f" {w[:-1]}" if w.endswith("*") else f" {w} ": x for w, x in lex.weights.items()}
        spared = [(i, i + len(p) + 1) for p in lex.exceptions for i in range(len(folded)) if folded.startswith(f" {p} ", i)]
        hits = [(i, x) for f, x in forms.items() for i in range(len(folded)) if folded.startswith(f, i)
                and not any(s <= i and i + len(f) - 1 <= e for s, e in spared)]
        n, weight = toxicity.matched(toxicity.fold(text or ""), a)
        assert n == len(hits) and abs(weight - sum(x for _, x in hits)) < 1e-9


def test_op2(spark):
    got = op2_suffix_array(spark, SF_SMALL).collect()
    want = test_exact_spans.brute(documents(spark), 200)
    assert sorted((True, r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == want


def test_op3(spark):
    rows = documents(spark)
    ids = dict(zip([k for k, _ in rows], test_packing.fresh_ids([t or "" for _, t in rows]), strict=True))
    pieces = op3_packing(spark, SF_SMALL).collect()
    at, fill = dict.fromkeys(ids, 0), {}
    for r in sorted(pieces, key=lambda r: (r.doc_id, r.start)):
        own = np.append(np.frombuffer(ids[r.doc_id], "<u4"), 1).astype("<u4")
        assert r.start == at[r.doc_id] and r.doc_tokens == len(own) and r.length > 0
        assert r.ids_crc32 == zlib.crc32(own[r.start:r.start + r.length].tobytes())
        at[r.doc_id] += r.length
        fill.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert all(at[k] == len(ids[k]) // 4 + 1 for k in ids)
    padding = 0
    for own in fill.values():
        end = 0
        for offset, n in sorted(own):
            assert offset == end
            end += n
        assert end <= 2048
        padding += 0 if end & (end - 1) == 0 else 2048 - end
    assert padding == 0


def test_op9(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    got = op9_epsilon_grid(spark, SF_SMALL).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == test_near_vectors.brute(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
