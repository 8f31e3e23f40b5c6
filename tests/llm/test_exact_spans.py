import collections
import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tabspark.llm import exact_spans


def brute(rows, length):
    raw = [(t or "").encode() for _, t in rows]
    places = collections.Counter(b[i:i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for (key, _), b in zip(rows, raw, strict=True):
        cut = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if places[b[i:i + length]] > 1:
                cut[i:i + length] = b"\1" * length
        kept = bytes(x for x, c in zip(b, cut, strict=True) if not c)
        spans = sum(c and (i == 0 or not cut[i - 1]) for i, c in enumerate(cut))
        out.append((key is not None, key or 0, len(b), sum(cut), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def corpus():
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 9))) for _ in range(60)]
    para = lambda n: " ".join(rng.choice(words) for _ in range(n))
    shared = [para(60) for _ in range(6)]
    texts = [para(rng.randint(0, 80)) + rng.choice(shared) + rng.choice(["", para(30) + rng.choice(shared)[:rng.randint(0, 400)]])
             for _ in range(100)]
    rows = list(enumerate(texts)) + [(200 + i, texts[3]) for i in range(3)]
    rows += [(300, None), (301, ""), (302, "x" * 1000), (303, "ab" * 700), (3, texts[5]), (304, "x" * 199), (None, shared[0]),
             (4, texts[4])]
    base = (shared[2] + para(50) + shared[3]).split(" ")
    for i in range(40):
        w = list(base)
        w[rng.randrange(len(w))] = rng.choice(words)
        rows.append((500 + i, " ".join(w)))
    return rows


@pytest.mark.parametrize("max_variants", [1024, 2])
def test_every_repeat_goes(make_docs, max_variants):
    rows = corpus()
    got = exact_spans.remove_repeats(make_docs(rows, extra=True), max_variants=max_variants).collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == brute(rows, 200)


@pytest.mark.parametrize("max_variants", [1024, 2])
def test_first_occurrence_stays(make_docs, max_variants):
    rows = [r for i, r in enumerate(corpus()) if r[0] is not None and r not in corpus()[:i]]
    docs = make_docs(rows)
    none = {(r.doc_id, r.n_bytes): r.n_removed for r in exact_spans.remove_repeats(docs, max_variants=max_variants).collect()}
    first = exact_spans.remove_repeats(docs, keep="first", keep_bytes=True, max_variants=max_variants).collect()
    assert all(r.n_removed <= none[r.doc_id, r.n_bytes] for r in first)
    # Every string of the input is still there: in what is kept, or in its first place.
    key = {(r.doc_id, r.text): r.k for r in docs.select("doc_id", "text", exact_spans.document_key("doc_id", "text").alias("k")).collect()}
    seen, want = set(), {}
    for k, text in sorted((key[r], r[1] or "") for r in rows):
        raw = text.encode()
        cut = bytearray(len(raw))
        for i in range(len(raw) - 199):
            s = raw[i:i + 200]
            if s in seen:
                cut[i:i + 200] = b"\1" * 200
            seen.add(s)
        want[hashlib.sha256(raw).hexdigest(), sum(cut)] = want.get((hashlib.sha256(raw).hexdigest(), sum(cut)), 0) + 1
    assert sum(r.n_removed for r in first) == sum(n * k for (_, n), k in want.items())


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 1000)), max_size=40, unique_by=lambda x: x[1]))
def test_previous_smaller(entries):
    entries = sorted(entries, key=lambda x: x[0])
    group = np.array([g for g, _ in entries], np.int64)
    place = np.array([p for _, p in entries], np.int64)
    got = exact_spans.previous_smaller(place, group)
    for i in range(len(entries)):
        want = max((j for j in range(i) if group[j] == group[i] and place[j] < place[i]), default=-1)
        assert got[i] == want


def test_suffix_order():
    rng = np.random.default_rng(1)
    rows = rng.integers(0, 2, (300, 6)).astype(np.uint8)
    group = rng.integers(0, 4, 300)
    order, common = exact_spans.suffix_order(rows, group)
    keys = [(int(g), bytes(r)) for g, r in zip(group, rows, strict=True)]
    assert [keys[i] for i in order] == sorted(keys)
    for x, y, c in zip(order[:-1], order[1:], common[1:], strict=True):
        same = next((i for i in range(6) if rows[x][i] != rows[y][i]), 6)
        assert c == (same if group[x] == group[y] else -1)


@pytest.mark.parametrize("letters", [2, 6])
def test_matches_of_windows(letters):
    rng = np.random.default_rng(letters)
    length, gram = 40, 8
    base = rng.integers(97, 97 + letters, (5, 160)).astype(np.uint8)
    texts = []
    for i in rng.integers(0, 5, 60):
        t = base[i].copy()
        t[rng.integers(0, 160, rng.integers(0, 4))] = rng.integers(97, 97 + letters)
        texts.append(t[rng.integers(0, 40):])
    data, offsets = np.concatenate(texts), np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    row, start, n, key, _ = exact_spans.windows(data, offsets, length, gram)
    by = np.argsort(key.view(np.int64), kind="stable")
    row, start, n, key = row[by], start[by], n[by], key[by]
    raw = [bytes(texts[r][s:s + c + length - 1]) for r, s, c in zip(row, start, n, strict=True)]
    whole, edges = np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in raw])])
    elsewhere, earlier = exact_spans.occurs(whole, edges, n, key.view(np.int64), row, start, length, gram)
    at, seen = 0, collections.defaultdict(list)
    for r, s, c, x in zip(row, start, n, raw, strict=True):
        for i in range(c):
            seen[x[i:i + length]].append((int(r), int(s) + i, at))
            at += 1
    assert at == len(elsewhere) and elsewhere.any() and not elsewhere.all()
    for places in seen.values():
        for p in places:
            assert elsewhere[p[2]] == (len(places) > 1) and earlier[p[2]] == (p != min(places))
    part = np.concatenate([[0], np.cumsum(n)])
    for a, b, got in zip(part[:-1], part[1:], exact_spans.stretches(elsewhere, part).to_pylist(), strict=True):
        cover = np.zeros(b - a, bool)
        for lo, hi in got:
            assert not cover[max(0, lo - 1):hi + 1].any()
            cover[lo:hi] = True
        assert (cover == elsewhere[a:b]).all()


def test_long_text_is_read_in_pieces(make_docs, monkeypatch):
    monkeypatch.setattr(exact_spans, "PIECE", 5000)
    rng = random.Random(3)
    part = "".join(rng.choice("abcdefgh") for _ in range(4900))
    rows = [(0, "".join(rng.choice("abcdefgh") for _ in range(12_345)) + part), (1, "é" * 7 + part + "z")]
    assert list(exact_spans.pieces(__import__("pyarrow").array([r[1] for r in rows]), 199))
    got = exact_spans.remove_repeats(make_docs(rows)).collect()
    assert {r.doc_id: r.n_removed for r in got} == {0: 4900, 1: 4900}


def test_empty_table(make_docs):
    assert exact_spans.remove_repeats(make_docs([])).count() == 0
