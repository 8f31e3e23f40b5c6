import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpora import prose
from fixture_paths import SF_SMALL
from tabspark.llm import near_text, tasks
from tabspark.llm.graph import components
from tabspark.llm.q_near_text import op10_order_minhash
from tabspark.llm.text import Words


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[-1] + 1))
        row = new
    return row[-1]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=14), st.lists(st.integers(0, 4), max_size=14), st.integers(0, 14))
def test_banded_distance(a, b, limit):
    d = distance(a, b)
    assert near_text.banded_distance(a, b, limit) == (d if d <= limit else None)
    assert near_text.wide_banded_distance(np.array(a, np.uint64), np.array(b, np.uint64), limit) == (d if d <= limit else None)


def test_wide_band_of_long_texts():
    rng = random.Random(5)
    a = [rng.randint(0, 400) for _ in range(900)]
    b = [rng.randint(0, 400) if rng.random() < 0.12 else x for x in a if rng.random() > 0.04]
    d = distance(a, b)
    assert 60 < d < 250
    assert near_text.wide_banded_distance(np.array(a), np.array(b), 250) == d == near_text.banded_distance(a, b, 250)
    assert near_text.wide_banded_distance(np.array(a), np.array(b), d - 1) is None


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 50), min_size=1, max_size=40), st.lists(st.tuples(st.integers(0, 39), st.integers(0, 60)), max_size=9))
def test_alike(a, edits):
    b = list(a)
    for i, x in edits:
        b[i % len(b)] = x
    d = distance(a, b)
    want = 1 - d / len(a) if d <= int(0.2 * len(a) + 1e-9) else None
    assert near_text.alike(np.array(a, np.uint64), np.array(b, np.uint64), 0.8) == want


def edited(rng, words, share):
    words = list(words)
    for i in rng.sample(range(len(words)), int(share * len(words))):
        words[i] = f"new{rng.randint(0, 10**6)}"
    return " ".join(words)


def brute(rows, similarity=0.8):
    """Class of each row by comparing all pairs."""
    words = Words(pa.array([t for _, t in rows], pa.string()))
    seq = [words.hash[words.first[i]:words.first[i + 1]] for i in range(len(rows))]
    top = list(range(len(rows)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        if len(seq[i]) and len(seq[j]) and near_text.alike(seq[i], seq[j], similarity) is not None:
            top[max(find(i), find(j))] = min(find(i), find(j))
    small = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            small[find(i)] = min(small.get(find(i), key), key)
    return [small.get(find(i)) for i in range(len(rows))]


def test_classes_equal_brute_force(make_docs):
    rng = random.Random(4)
    texts = [prose(rng, rng.randint(3, 200)) for _ in range(40)]
    for t in texts[:12]:
        texts += [edited(rng, t.split(), share) for share in (0.02, 0.04, 0.06)] + [t, t.upper() + " !!"]
    common = prose(rng, 60)
    texts += [f"{prose(rng, 90)} {common} {prose(rng, 90)}" for _ in range(30)]  # a shared passage makes no copies
    base = prose(rng, 150)
    texts += [edited(rng, base.split(), 0.05) for _ in range(60)]
    texts += [None, "", "...", "one", "one", "ONE!", "a b c d", None, ""]
    rows = list(enumerate(texts)) + [(3, texts[3]), (5, base)]
    docs = make_docs(rows, extra=True)
    got = {}
    for r in near_text.near_duplicates(docs).collect():
        got.setdefault(r.doc_id, []).append(r.class_id)
        assert r.kept == (r.doc_id == r.class_id)
    want = {}
    for (key, _), c in zip(rows, brute(rows), strict=True):
        want.setdefault(key, []).append(c)
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}


def test_null_ids_and_empty_table(make_docs):
    got = near_text.near_duplicates(make_docs([(None, "a b c d e f"), (1, "a b c d e f"), (None, None)])).collect()
    assert sorted((r.doc_id is None, r.class_id, r.kept) for r in got) == [(False, 1, True), (True, None, False), (True, None, False)] \
        or {(r.doc_id, r.class_id, r.kept) for r in got} == {(None, None, False), (1, 1, True)}
    assert near_text.near_duplicates(make_docs([])).count() == 0


def test_order_counts():
    rng = random.Random(1)
    words = prose(rng, 120).split()
    half = len(words) // 2
    texts = pa.array([" ".join(words), " ".join(words[half:] + words[:half])])
    w = Words(texts)
    assert near_text.alike(w.hash[:w.first[1]], w.hash[w.first[1]:], 0.8) is None
    assert near_text.sequence_keys(w)[0] != near_text.sequence_keys(w)[1]


def test_very_long_text(make_docs):
    rng = random.Random(2)
    long = [f"w{rng.randint(0, 5000)}" for _ in range(20_000)]
    got = near_text.near_duplicates(make_docs([" ".join(long), edited(rng, long, 0.01), prose(rng, 50)])).collect()
    assert {r.doc_id: r.class_id for r in got} == {0: 0, 1: 0, 2: 2}


@pytest.mark.parametrize("n, m", [(30, 20), (60, 70), (200, 150)])
def test_components(spark, n, m):
    rng = random.Random(n)
    links = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)] + [(i, i + 1) for i in range(1000, 1040)] + [(None, 3)]
    top = {x: x for e in links for x in e}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            top[max(find(a), find(b))] = min(find(a), find(b))
    want = {x: find(x) for a, b in links if a is not None and a != b for x in (a, b)}
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert len(got) == len(want) and {r.node: r.component for r in got} == want


def test_estimated_sizes_stay_small_over_rounds(spark):
    """A chain takes several rounds; the driver's estimate of the result must not be multiplied by each of their joins."""
    ids = np.random.default_rng(5).permutation(400).tolist()
    links = spark.createDataFrame(list(zip(ids, ids[1:])), "a long, b long").repartition(3)
    got = components(links)
    size = got._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    assert size < 1 << 64
    rows = got.collect()
    assert {r.node for r in rows} == set(ids) and len(rows) == 400 and {r.component for r in rows} == {0}


def spread(rng, words, share):
    """Every 1/share-th word changed, from the middle of each stretch on."""
    words, step = list(words), round(1 / share)
    for i in range(step // 2, len(words), step):
        words[i] = f"new{rng.randint(0, 10**6)}"
    return words


KINDS = {
    "300 words, 10 %": (300, lambda r, w: edited(r, w, 0.10).split()), "300 words, 15 %": (300, lambda r, w: edited(r, w, 0.15).split()),
    "300 words, 18 %": (300, lambda r, w: edited(r, w, 0.18).split()), "300 words, 20 %": (300, lambda r, w: edited(r, w, 0.20).split()),
    "200 words, every fifth": (200, lambda r, w: spread(r, w, 0.2)), "400 words, every fifth": (400, lambda r, w: spread(r, w, 0.2)),
    "60 words, every fifth": (60, lambda r, w: spread(r, w, 0.2)), "20 words, every fifth": (20, lambda r, w: spread(r, w, 0.2)),
    "15 words, every fifth": (15, lambda r, w: spread(r, w, 0.2)), "10 words, every fifth": (10, lambda r, w: spread(r, w, 0.2)),
    "10 words, middle": (10, lambda r, w: w[:5] + ["new"] + w[6:]), "7 words, middle": (7, lambda r, w: w[:3] + ["new"] + w[4:]),
    "6 words, last": (6, lambda r, w: w[:5] + ["new"]), "5 words, middle": (5, lambda r, w: w[:2] + ["new"] + w[3:]),
    "300 words, a block moved out": (300, lambda r, w: w[:100] + w[150:]),
}


@pytest.mark.parametrize("kind", list(KINDS))
def test_alike_texts_share_a_sketch(kind):
    """At least 99 of 100 pairs with a similarity of 0.8 or more are candidates."""
    n, change = KINDS[kind]
    rng = random.Random(kind)
    vocabulary = [f"w{i}" for i in range(3000)]
    firsts = [[rng.choice(vocabulary) for _ in range(n)] for _ in range(300)]
    words = Words(pa.array([" ".join(x) for w in firsts for x in (w, change(rng, w))]))
    keys, at = near_text.all_keys(words, near_text.K_WORDS)
    seq = [words.hash[words.first[i]:words.first[i + 1]] for i in range(600)]
    assert all(near_text.alike(seq[i], seq[i + 1], 0.8) is not None for i in range(0, 600, 2))
    met = sum(bool(np.intersect1d(keys[at[i]:at[i + 1]], keys[at[i + 1]:at[i + 2]]).size) for i in range(0, 600, 2))
    assert met >= 297, met


def test_unlike_texts_share_none():
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(3000)]
    words = Words(pa.array([" ".join(rng.choice(vocabulary) for _ in range(300)) for _ in range(400)]))
    keys, _ = near_text.all_keys(words, near_text.K_WORDS)
    assert len(np.unique(keys)) == len(keys)


def test_boilerplate(make_docs):
    """Pages that share most of their words, but not 0.8, and among them pairs that differ in their own words only."""
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(4000)]
    plate = [rng.choice(vocabulary) for _ in range(270)]
    own = [[rng.choice(vocabulary) for _ in range(110)] for _ in range(600)]
    pages = own + [spread(rng, own[i], 0.2) for i in range(40)]
    docs = make_docs([" ".join(plate[:135] + p + plate[135:]) for p in pages])
    got = {r.doc_id: r.class_id for r in near_text.near_duplicates(docs).collect()}
    want = {i: i for i in range(600)} | {600 + i: i for i in range(40)}
    assert sum(got[i] != want[i] for i in want) == 0


def test_pairs_alike_by_a_boilerplate(make_docs):
    """Pages without an own k-mer in common share only buckets that hold most pages; none of their links is lost."""
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(4000)]
    plate = [rng.choice(vocabulary) for _ in range(135)]
    own = [[rng.choice(vocabulary) for _ in range(54)] for _ in range(160)]
    pages = own + [spread(rng, p, 0.5) for p in own[:30]]
    rows = [(i, " ".join(plate[:60] + p + plate[60:])) for i, p in enumerate(pages)]
    got = {r.doc_id: r.class_id for r in near_text.near_duplicates(make_docs(rows)).collect()}
    assert [got[i] for i in range(len(rows))] == brute(rows) == [*range(160), *range(30)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 6), min_size=1, max_size=25), st.lists(st.tuples(st.integers(0, 24), st.integers(0, 9)), max_size=6),
       st.integers(1, 3), st.sampled_from([0.5, 0.8, 0.9]), st.integers(0, 9))
def test_alike_texts_share_a_prefix(a, edits, k, similarity, seed):
    """Whatever order the k-mers are put in, no pair that is alike is ruled out."""
    b = list(a)
    for at, x in edits:
        b[at % len(b):at % len(b) + (x % 3 != 1)] = [x] * (x % 3 != 2) or b[:1]
    seq = [np.array(x, np.uint64) for x in (a, b)]
    words = near_text._Sequences(pa.array([x.tobytes() for x in seq]))
    counts = np.random.default_rng(seed).integers(0, 5, 1 << near_text.CELL_BITS)
    keys, at = near_text.prefixes(words, k, similarity, counts)
    if near_text.alike(*seq, similarity) is not None:
        assert a == b or np.intersect1d(keys[:at[1]], keys[at[1]:]).size


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 6), min_size=1, max_size=90), st.lists(st.tuples(st.integers(0, 89), st.integers(0, 9)), max_size=12),
       st.integers(1, 3), st.sampled_from([0.5, 0.8, 0.9]), st.integers(0, 9))
def test_alike_texts_share_enough_of_their_prefixes(a, edits, k, similarity, seed):
    """The number of k-mers that ``further_pairs`` asks for is never more than a pair that is alike has in common."""
    b = list(a)
    for at, x in edits:
        b[at % len(b):at % len(b) + (x % 3 != 1)] = [x] * (x % 3 != 2) or b[:1]
    seq = [np.array(x, np.uint64) for x in (a, b)]
    words = near_text._Sequences(pa.array([x.tobytes() for x in seq]))
    counts = np.random.default_rng(seed).integers(0, 5, 1 << near_text.CELL_BITS)
    keys, at = near_text.prefixes(words, k, similarity, counts)
    _, spare = near_text.prefix_lengths(np.diff(words.first), k, similarity)
    longer = max(len(a), len(b))
    need = spare.min() + longer - k + 1 - k * int((1 - similarity) * longer + 1e-9)
    if near_text.alike(*seq, similarity) is not None:
        assert a == b or np.intersect1d(keys[:at[1]], keys[at[1]:]).size >= max(need, 1)


def test_few_rare_words_in_common_make_no_pair(spark):
    """41 texts, each with a run of five words in common with each other one: no pair can be alike, none is compared."""
    rows = []
    for i in range(41):
        runs = [np.arange(5) + 5 * (min(i, j) * 41 + max(i, j)) for j in range(41) if j != i]
        rows.append((i, i, bytearray(np.concatenate(runs).astype(np.uint64).tobytes())))
    texts = spark.createDataFrame(rows, "node long, class long, words binary")
    assert near_text.further_pairs(texts, 2, 0.8).count() == 0
    near = bytearray(np.concatenate([np.frombuffer(rows[0][2], np.uint64)[:160], np.arange(40, dtype=np.uint64) + 10**6]).tobytes())
    more = texts.union(spark.createDataFrame([(41, 41, near)], texts.schema))
    assert [tuple(r) for r in near_text.further_pairs(more, 2, 0.8).collect()] == [(0, 41)]


def block_row(node, cls, words, k=2):
    w = near_text._Sequences(pa.array([np.array(words, np.uint64).tobytes()]))
    return {"node": node, "class": cls, "buckets": [5], "n": len(words), "words": near_text.signatures(w, 1)[0],
            "kmers": near_text.signatures(w, k)[0]}


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 6), min_size=1, max_size=90), st.lists(st.tuples(st.integers(0, 89), st.integers(0, 9)), max_size=12),
       st.integers(1, 3), st.sampled_from([0.5, 0.8, 0.9]))
def test_alike_texts_pass_the_signatures(a, edits, k, similarity):
    """No pair that is alike is ruled out, also if one signature is longer; nothing is paired within a class."""
    b = list(a)
    for at, x in edits:
        b[at % len(b):at % len(b) + (x % 3 != 1)] = [x] * (x % 3 != 2) or b[:1]
    with pytest.MonkeyPatch.context() as m:
        m.setattr(near_text, "LEAST_BITS", 64)
        rows = [block_row(7, 1, a, k), block_row(3, 2, b, k)]
    got = [list(zip(*(z.tolist() for z in near_text.near_in_blocks(x, y, k, similarity))))
           for both in [near_text._Block(rows, 5)] for x, y in [(both, both), tuple(near_text._Block([r], 5) for r in rows)]]
    if near_text.alike(np.array(a, np.uint64), np.array(b, np.uint64), similarity) is not None:
        assert got == [[(3, 7)]] * 2
    both = near_text._Block([r | {"class": 1} for r in rows], 5)
    assert not len(near_text.near_in_blocks(both, both, k, similarity)[0])


def test_pairs_ruled_out_bring_no_words_together(spark):
    rng = np.random.default_rng(4)
    base = rng.integers(0, 10**9, 130)
    rows = {1: base, 2: np.concatenate([base[:115], rng.integers(0, 10**9, 12)]), 3: rng.integers(0, 10**9, 130), 4: base[:40]}
    marks = spark.createDataFrame([tuple(block_row(i, 0, w)[c] for c in near_text.MARK.names) for i, w in rows.items()], near_text.MARK)
    pairs = spark.createDataFrame(list(itertools.combinations(rows, 2)), "a long, b long")
    assert [tuple(r) for r in near_text.maybe_alike(pairs, marks, 2, 0.8).collect()] == [(1, 2)]


def test_large_buckets_are_compared_in_blocks(spark, monkeypatch):
    """Each pair of a bucket that is alike and of two classes is found, however its nodes are dealt; none of other buckets."""
    rng = np.random.default_rng(3)
    base, words = rng.integers(0, 10**9, 100), {}
    for i in range(60):
        words[i] = base.copy() if i < 40 else rng.integers(0, 10**9, 100)
        words[i][rng.choice(100, 5, replace=False)] = rng.integers(0, 10**9, 5)
    words[58][:90], words[59][:90] = words[41][:90], words[41][:90]
    words[60] = words[41].copy()
    words[60][:3] = 1
    cls = {i: 0 if i < 38 else i for i in words}
    bucket = [(0, i) for i in range(59)] + [(1, 41), (1, 58), (1, 59)] + [(2, 60), (2, 2)]  # 41 and 58 share two, named once
    marks = spark.createDataFrame([tuple(block_row(i, 0, w)[c] for c in near_text.MARK.names) for i, w in words.items()], near_text.MARK)
    member = spark.createDataFrame([(b, i, cls[i]) for b, i in bucket], "bucket long, node long, class long")
    want = {(a, b) for a in words for b in words if a < b and cls[a] != cls[b] and {x for x, i in bucket if i == a} & {x for x, i in bucket if i == b}
            and near_text.alike(words[a].astype(np.uint64), words[b].astype(np.uint64), 0.8) is not None}
    assert {(41, 58), (41, 59), (58, 59), (38, 39)} <= want and (41, 60) not in want
    for size in (4, 1024):
        monkeypatch.setattr(near_text, "BLOCK", size)
        assert sorted(tuple(r) for r in near_text.pairs_in_blocks(marks, member, 2, 0.8).collect()) == sorted(want)


def test_long_batches_are_looked_at_in_pieces():
    batch = pa.RecordBatch.from_pydict({"id": list(range(400)), "text": ["x" * 10_000] * 399 + [None]})
    parts = list(tasks.pieces([batch, batch.slice(0, 0)], 1))
    assert sum(p.num_rows for p in parts) == 400 and [i for p in parts for i in p.column(0).to_pylist()] == list(range(400))
    assert all(p.column(1).nbytes <= 2 * tasks.PIECE_BYTES for p in parts)


def test_short_texts_equal_brute_force(make_docs):
    rng = random.Random(10)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = []
    for _ in range(120):
        w = [rng.choice(vocabulary) for _ in range(rng.randint(1, 14))]
        texts.append(" ".join(w))
        if rng.random() < 0.6:
            i = rng.randrange(len(w))
            texts.append(" ".join(w[:i] + rng.choice([[], ["new"], [w[i], "new"]]) + w[i + 1:]))
    rows = list(enumerate(texts))
    got = [r.class_id for r in sorted(near_text.near_duplicates(make_docs(rows)).collect(), key=lambda r: r.doc_id)]
    want = brute(rows)
    assert sum(a != b for a, b in zip(got, want, strict=True)) <= 1


def test_query_function(spark):
    got = op10_order_minhash(spark, SF_SMALL).collect()
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    want = dict(zip([k for k, _ in rows], brute(rows), strict=True))
    assert {r.doc_id: r.class_id for r in got} == want and all(r.kept == (r.class_id == r.doc_id) for r in got)
