"""Benchmark decontamination by latent semantic retrieval.

Documents are read as passages of ``PASSAGE`` words, one every ``STEP``
words. A passage is a TF-IDF vector over the benchmark's vocabulary; a
randomised SVD of all passages (one multiplication of the passage matrix
and its transpose with a random matrix, summed up in Spark) gives the
latent space, whose axes are divided by their singular values: without
that, the common words of all passages would make them alike. Passages
whose cosine with a benchmark passage reaches ``min_cosine`` there are
candidates. So is, for every item, each stretch that holds enough of its
rarest words: whoever has a share ``paraphrase`` of all its words has them,
so an item of words that are frequent everywhere, or that itself is, is
found as well. Around each, a longest common subsequence of words decides:

* a copy: the subsequence covers at least ``copy`` of the item's words;
* a paraphrase: at least ``paraphrase`` of them and, as an answer check, at
  least ``answer`` of the item's last sentence, in order.

The benchmark is the query set, its vocabulary (its distinct words) and its
vectors go to all tasks; ``MAX_ITEM_WORDS`` bounds them, a larger benchmark
is taken in slices that fit. Document counts and the SVD cover all
documents.

Defined cases
* null text and text without words: never leaked. Items without words are never matched; those with fewer than
  ``min_words`` words are found where all their words stand one after the other.
* ties between items: the one with the most words in common, then the smallest id.
* an item that repeats counts once per row; documents with null or repeated ids are judged row by row.
* an empty documents table gives no rows; an empty benchmark leaks nothing.
* columns besides id and text are dropped.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabspark.llm.tasks import output_type, record_batch
from tabspark.llm.text import Words

PASSAGE, STEP, RANK = 32, 16, 48
#: Random columns beside RANK.
EXTRA = 16
#: Words that at most this share of all steps has are an item's rare ones; more frequent ones are taken only as needed.
COMMON = 0.03
#: Share of an item passage's words that aren't frequent that a candidate by cosine has (candidates by rare words need none).
SHARED = 0.35
#: Words of the benchmark items that go to the tasks at once (8 bytes each, and RANK + 2 numbers per distinct word).
MAX_ITEM_WORDS = 20_000


@dataclass
class Items:
    """Benchmark items as word hashes, with their vocabulary."""

    ids: list
    words: list[np.ndarray]
    answer: list[int]  # the index of the first word of the last sentence
    vocabulary: np.ndarray  # sorted
    short: list[np.ndarray] = field(default_factory=list)  # items of few words; their ids follow the others'

    def __post_init__(self):
        # The top 16 bits of a hash lead to its place among the sorted ones.
        self.top = np.searchsorted(self.vocabulary >> np.uint64(48), np.arange((1 << 16) + 1, dtype=np.uint64))
        self.deepest = int(np.diff(self.top).max(initial=0))
        self.lists = [w.tolist() for w in self.words]
        self.places = [places(w) for w in self.lists]
        self.counts = [dict(zip(*(x.tolist() for x in np.unique(w, return_counts=True)), strict=True))
                       for w in self.words]

    def weighted(self, hashes: np.ndarray, idf: np.ndarray) -> np.ndarray:
        """As ``columns``, with -1 for words without weight too."""
        column = self.columns(hashes)
        return np.where(np.append(idf, 0.0)[column] > 0, column, -1)

    def columns(self, hashes: np.ndarray) -> np.ndarray:
        """The vocabulary index of each hash, -1 for other words."""
        out = np.full(len(hashes), -1, np.int32)
        if not len(self.vocabulary):
            return out
        high = (hashes >> np.uint64(48)).astype(np.int64)
        lo, hi = self.top[high], self.top[high + 1]
        for d in range(self.deepest):
            at = np.flatnonzero(lo + d < hi)
            hit = at[self.vocabulary[lo[at] + d] == hashes[at]]
            out[hit] = lo[hit] + d
        return out


def items_of(rows: list[tuple], min_words: int) -> Items:
    """Items from (id, text) rows; those with fewer than ``min_words`` words are matched as they stand, empty ones are left out."""
    ids, words, answer, short = [], [], [], []
    whole = Words(pa.array([t for _, t in rows], pa.string()))
    for i, (key, text) in enumerate(rows):
        a, b = int(whole.first[i]), int(whole.first[i + 1])
        if b - a < max(1, min_words):
            if b > a:
                short.append((key, whole.hash[a:b].copy()))
            continue
        raw = bytes(whole.data[whole.offsets[i]:whole.offsets[i + 1]])
        body = raw.rstrip(b" .!?\n\t\r\"')")
        stop = max(body.rfind(c) for c in (b". ", b"? ", b"! ", b"\n"))
        first = int(np.searchsorted(whole.start[a:b], whole.offsets[i] + stop + 1)) if stop >= 0 else 0
        ids.append(key)
        words.append(whole.hash[a:b].copy())
        answer.append(min(first, b - a - 1))
    vocabulary = np.unique(np.concatenate(words)) if words else np.zeros(0, np.uint64)
    return Items(ids + [k for k, _ in short], words, answer, vocabulary, [w for _, w in short])


def steps(n_words: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, first step) of the steps of ``step`` words of each row, the last one shorter."""
    count = -(-n_words // step)
    return np.repeat(np.arange(len(n_words)), count), np.concatenate([[0], np.cumsum(count)])


def frequent_counts(at: np.ndarray, place: np.ndarray, n: int, n_steps: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """How often each of ``n`` frequent words stands in the steps lo to hi, for all of them in pieces.

    ``at``: the step of each word, sorted; ``place``: which of the words it is, -1 for others.
    """
    for lo in range(0, n_steps if n else 0, 4096):
        hi = min(lo + 4096, n_steps)
        a, b = np.searchsorted(at, [lo, hi])
        some = a + np.flatnonzero(place[a:b] >= 0)
        yield lo, hi, np.bincount((at[some] - lo) * n + place[some], minlength=(hi - lo) * n).reshape(-1, n).astype(np.float32)


def passages(words: Words, column: np.ndarray, weight: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(vectors, row, first step of the row, words with weight, their step) of a batch.

    ``vectors`` has a row for each passage: the sum of the weights of the
    words in PASSAGE // STEP steps from its own on, in its document. Words
    with column -1 have no weight. ``frequent``: words that are counted first.
    """
    row, first = steps(np.diff(words.first), STEP)
    known = np.flatnonzero(column >= 0)
    r = words.row[known]
    at = first[r] + (known - words.first[r]) // STEP
    vectors = np.zeros((len(row) + PASSAGE // STEP, weight.shape[1]), np.float32)
    place = places_of(frequent, len(weight))[column[known]]
    for lo, hi, counts in frequent_counts(at, place, len(frequent), len(row)):
        vectors[lo:hi] = counts @ weight[frequent]
    rest = place < 0
    if rest.any():
        to, own = at[rest], column[known][rest]
        edge = np.flatnonzero(np.diff(to, prepend=-1))
        left = np.diff(np.append(edge, len(to)))
        where = to[edge]
        for j in range(STEP):  # the j-th word with weight of every step that has one
            vectors[where] += weight[own[edge + j]]
            more = left > j + 1
            edge, left, where = edge[more], left[more], where[more]
            if not len(edge):
                break
    vectors = window_sum(vectors[:len(row)], row)
    return vectors, row, first, known, at


def places_of(frequent: np.ndarray, n_words: int) -> np.ndarray:
    """For each vocabulary word its index in ``frequent``, or -1."""
    out = np.full(n_words, -1, np.int64)
    out[frequent] = np.arange(len(frequent))
    return out


def window_sum(x: np.ndarray, row: np.ndarray, back: bool = False) -> np.ndarray:
    """For each step, the sum over it and the next (or the last) PASSAGE // STEP - 1 steps of its row."""
    out = x.copy()
    for j in range(1, PASSAGE // STEP):
        if len(x) <= j:
            break
        same = (row[j:] == row[:-j])[:, None]
        if back:
            out[j:] += x[:-j] * same
        else:
            out[:-j] += x[j:] * same
    return out


def places(words: list[int]) -> dict[int, int]:
    """For each word, the bits of its places in the sequence."""
    out: dict[int, int] = {}
    for i, x in enumerate(words):
        out[x] = out.get(x, 0) | (1 << i)
    return out


def lcs_length(n: int, at: dict[int, int], other: list[int]) -> int:
    """Longest common subsequence of ``n`` words at ``places`` and ``other``, one bit per word (integers of any length)."""
    full = row = (1 << n) - 1
    for x in other:
        u = row & at.get(x, 0)
        if u:
            row = ((row + u) | (row - u)) & full
    return n - row.bit_count()


# -------------------------------------------------------------- Spark jobs

_SUMS = T.StructType([T.StructField("term", T.IntegerType()), T.StructField("s", T.ArrayType(T.DoubleType()))])


def _count(items: Items, schema: pa.Schema):
    """Number of passage steps that have each vocabulary word, and of all steps (term -1)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(len(items.vocabulary)), 0
        for batch in batches:
            words = Words(batch.column(0))
            column = items.columns(words.hash)
            row, first = steps(np.diff(words.first), STEP)
            known = np.flatnonzero(column >= 0)
            r = words.row[known]
            at = first[r] + (known - words.first[r]) // STEP
            # A word that a step repeats stands next to its twin only by chance; it may count twice.
            total += np.bincount(column[known], minlength=len(total)) if len(at) else 0
            n += len(row)
        yield record_batch(schema, [-1, *range(len(total))], [[float(n)], *([float(x)] for x in total)])

    return run


def _multiply(items: Items, idf: np.ndarray, random: np.ndarray, frequent: np.ndarray, schema: pa.Schema):
    """Rows of the product (passages transposed) x (passages) x random, summed within a task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(items.vocabulary), random.shape[1]))
        weight = (idf[:, None] * random).astype(np.float32)
        for batch in batches:
            words = Words(batch.column(0))
            column = items.weighted(words.hash, idf)
            vectors, row, _, known, at = passages(words, column, weight, frequent)
            if not len(known):
                continue
            norm = np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
            vectors /= np.maximum(norm, 1e-12)  # long runs of common words don't outweigh the rest
            covering = window_sum(vectors, row, back=True)
            place = places_of(frequent, len(total))[column[known]]
            for lo, hi, counts in frequent_counts(at, place, len(frequent), len(row)):
                total[frequent] += counts.T @ covering[lo:hi]
            known, at = known[place < 0], at[place < 0]
            own = column[known].astype(np.uint16) if len(total) < 1 << 16 else column[known]
            order = np.argsort(own, kind="stable")
            for lo in range(0, len(order), 1 << 16):
                some = order[lo:lo + (1 << 16)]
                edge = np.flatnonzero(np.diff(own[some].astype(np.int64), prepend=-1))
                total[own[some][edge]] += np.add.reduceat(covering[at[some]], edge, axis=0)
        total *= idf[:, None]
        some = np.flatnonzero(total.any(axis=1))
        yield record_batch(schema, pa.array(some.astype(np.int32)), [r.tolist() for r in total[some]])

    return run


def _gather(rows: DataFrame, width: int) -> dict[int, list[float]]:
    """Sums by term of the tasks' arrays; the driver gets one array per vocabulary word."""
    total = rows.groupBy("term").agg(*[F.sum(F.get("s", F.lit(j))).alias(f"s{j}") for j in range(width)])
    return {r["term"]: [r[f"s{j}"] for j in range(width)] for r in total.collect()}


@dataclass
class Rare:
    """An item's rarest words, and how often they stand in any stretch that has a given share of all its words."""

    words: np.ndarray  # vocabulary indexes
    need: int
    span: int  # steps that such a stretch touches at most


def stretch(n: int) -> int:
    """Words of a document that an item of ``n`` words may be spread over."""
    return max(n + 4, n * 3 // 2)


def rare_words(column: np.ndarray, df: np.ndarray, n_steps: float, share: float) -> Rare:
    """The rare words of an item (``column``: its words), and more, rarest first, until an eighth of it must be met."""
    words, count = np.unique(column, return_counts=True)
    order = np.lexsort((words, df[words]))
    words, held = words[order], np.cumsum(count[order])
    n = len(column)
    spared = n - int(np.ceil(share * n - 1e-9))  # words that may be missing
    least = min(spared + max(1, n // 8), n)
    m = max(int(np.searchsorted(held, least)) + 1, int((df[words] <= COMMON * n_steps).sum()))
    return Rare(words[:m], max(1, int(held[m - 1]) - spared), (stretch(n) + STEP - 2) // STEP + 1)


def holding(rare: Rare, at: np.ndarray, row: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The middle steps of all runs of ``rare.span`` steps of a row that hold its words often enough.

    ``at``: the step of each place of one of the words, sorted.
    """
    if len(at) < rare.need:
        return at[:0]
    begin, end = at[:len(at) - rare.need + 1], at[rare.need - 1:]
    begin = np.unique(begin[(end - begin < rare.span) & (row[begin] == row[end])])
    return np.unique(np.minimum(begin + rare.span // 2, first[row[begin] + 1] - 1))


@dataclass
class Space:
    """Latent space: idf of each vocabulary word, its latent vector, and the items' passages there."""

    idf: np.ndarray
    basis: np.ndarray  # words x rank, singular vectors divided by their singular values
    queries: np.ndarray  # unit rows
    owner: np.ndarray  # the item of each query
    size: np.ndarray  # how many words each query has that aren't frequent
    member: np.ndarray  # items x words: whether an item has a word that isn't frequent
    fewest: int  # words with weight that a passage needs to be like any query
    rare: list[Rare]  # of each item
    frequent: np.ndarray  # the words of more than COMMON of the steps


def space_of(items: Items, idf: np.ndarray, basis: np.ndarray, rare: list[Rare],
             frequent: np.ndarray) -> Space:
    """The space with the items' passages of PASSAGE words (an item's last one ends with it)."""
    vectors, owner, size = [], [], []
    weight = idf[:, None] * basis
    member = np.zeros((len(items.words), len(idf)), np.uint8)
    for i, w in enumerate(items.words):
        starts = range(0, max(1, len(w) - PASSAGE // 2), PASSAGE) if len(w) > PASSAGE else [0]
        for s in sorted({min(s, max(0, len(w) - PASSAGE)) for s in starts}):
            c = items.weighted(w[s:s + PASSAGE], idf)
            v = weight[c[c >= 0]].sum(axis=0)
            vectors.append(v / max(float(np.sqrt(v @ v)), 1e-12))
            owner.append(i)
            size.append(int((~np.isin(c, frequent)).sum()))
        member[i, items.columns(w)] = 1
    member[:, frequent] = 0
    return Space(idf, basis, np.array(vectors, np.float32).reshape(-1, weight.shape[1]), np.array(owner, np.int64),
                 np.array(size, np.int64), member, max(1, int(np.ceil(SHARED * min(size, default=1)))), rare, frequent)


def latent_space(docs: DataFrame, items: Items, text_col: str = "text", share: float = 0.6, rank: int = RANK,
                 seed: int = 7) -> Space:
    """Randomised SVD of all passages' TF-IDF vectors over the items' vocabulary.

    ``share``: of an item's words, what a document that holds it has at least.
    """
    own = docs.select(F.col(text_col).cast("string"))
    n_words = len(items.vocabulary)
    width = min(rank + EXTRA, n_words)
    out = output_type(_SUMS)
    counts = _gather(own.mapInArrow(_count(items, out), _SUMS), 1)
    n = counts.get(-1, [0.0])[0]
    df = np.array([counts.get(t, [0.0])[0] for t in range(n_words)])
    idf = np.log((n + 1) / (df + 1)).clip(min=0) + 0.1
    frequent = np.flatnonzero(df > COMMON * n)
    random = np.random.default_rng(seed).normal(size=(n_words, width))
    product = _gather(own.mapInArrow(_multiply(items, idf, random, frequent, out), _SUMS), width)
    y = np.zeros((n_words, width))
    for t, s in product.items():
        y[t] = s
    # The items are passages as well; this keeps words that no document has.
    for w in items.words:
        c = items.columns(w)
        v = (idf[c, None] * random[c]).sum(axis=0)
        y[c] += idf[c, None] * v / max(np.sqrt(v @ v), 1e-12)
    # y is the (symmetric) product of passages with random: its eigenvectors follow from y and random alone.
    scale = max(np.abs(y).max(initial=0.0), 1e-12)
    core = random.T @ (y / scale)
    values, turn = np.linalg.eigh((core + core.T) / 2)
    good = values > values.max(initial=0.0) * 1e-9
    left, singular, _ = np.linalg.svd((y / scale) @ (turn[:, good] / np.sqrt(values[good])), full_matrices=False)
    basis = left[:, :rank] / np.maximum(singular[:rank], 1e-9)
    return space_of(items, idf, basis, [rare_words(items.columns(w), df, n, share) for w in items.words],
                    frequent)


def judge_batch(column: pa.Array, items: Items, space: Space, weight: np.ndarray, min_cosine: float,
                paraphrase: float, copy: float, answer: float) -> dict[int, list[tuple[float, float, int, int]]]:
    """Row -> its leaked items as (coverage, share of the answer, item, first word of the passage), the best first."""

    def check(p: int, item: int, before: int = 0) -> None:
        r, told = int(row[p]), items.lists[item]
        n = len(told)
        at = int(words.first[r]) + (p - int(first[r])) * STEP
        old = best.get((r, item))
        if old is not None and old[0] == 1:
            return
        here = words.hash[max(int(words.first[r]), at - n - before):min(int(words.first[r + 1]), at + PASSAGE + n)].tolist()
        # Words in common bound the subsequence from above.
        if common_words(items.counts[item], here) < paraphrase * n:
            return
        share = lcs_span(n, items.places[item], here) / n
        if share >= paraphrase and (old is None or share > old[0]):
            tail = told[items.answer[item]:]
            best[r, item] = (share, lcs_span(len(tail), places(tail), here) / len(tail), at)

    words = Words(column)
    own = items.weighted(words.hash, space.idf)
    vectors, row, first, known, step = passages(words, own, weight, space.frequent)
    best: dict[tuple[int, int], tuple[float, float, int]] = {}
    if not len(known):
        return {}
    vectors /= np.maximum(np.sqrt((vectors * vectors).sum(axis=1, keepdims=True)), 1e-12)
    begin = np.searchsorted(step, np.arange(len(row)))
    end = np.searchsorted(step, np.minimum(np.arange(len(row)) + PASSAGE // STEP, first[row + 1]))
    some = np.flatnonzero(end - begin >= space.fewest)
    own = own[known]
    for lo in range(0, len(some), 4096):
        p, q = np.nonzero(vectors[some[lo:lo + 4096]] @ space.queries.T >= min_cosine)
        p, item = some[lo + p], space.owner[q]
        # Of an item's words that aren't frequent, a share must be in the passage at all.
        n = end[p] - begin[p]
        pair = np.repeat(np.arange(len(p)), n)
        word = own[begin[p][pair] + np.arange(len(pair)) - np.repeat(np.cumsum(n) - n, n)]
        shared = np.bincount(pair, weights=space.member[item[pair], word], minlength=len(p))
        for i in np.flatnonzero(shared >= SHARED * space.size[q]).tolist():
            check(int(p[i]), int(item[i]))
    order = np.argsort(own, kind="stable")
    at, edge = step[order], np.searchsorted(own[order], np.arange(len(items.vocabulary) + 1))
    for i, rare in enumerate(space.rare):
        held = [at[edge[c]:edge[c + 1]] for c in rare.words.tolist() if edge[c + 1] > edge[c]]
        for p in holding(rare, np.sort(np.concatenate(held)), row, first).tolist() if held else ():
            check(p, i, STEP)
    out: dict[int, list[tuple[float, float, int, int]]] = {}
    for (r, item), (share, told, at) in best.items():
        if share >= copy or told >= answer:
            out.setdefault(r, []).append((share, told, item, at - int(words.first[r])))
    for found in out.values():
        found.sort(key=lambda x: (-x[0] * len(items.words[x[2]]), x[2]))
    return out


def short_hits(column: pa.Array, items: Items) -> list[tuple[int, int, int]]:
    """(row, item, first word) of the first place where a row has all words of a short item, one after the other."""
    if not items.short:
        return []
    words, out = Words(column), []
    last = words.first[1:][words.row]
    at = np.arange(len(words.hash))
    for i, told in enumerate(items.short, len(items.words)):
        some = at[at + len(told) <= last]
        for k, w in enumerate(told):
            some = some[words.hash[some + k] == w]
        rows, nth = np.unique(words.row[some], return_index=True)
        out += [(int(r), i, int(p - words.first[r])) for r, p in zip(rows, some[nth], strict=True)]
    return out


def common_words(counts: dict[int, int], here: list[int]) -> int:
    left, common = dict(counts), 0
    for x in here:
        if left.get(x, 0):
            left[x] -= 1
            common += 1
    return common


def lcs_span(n: int, at: dict[int, int], here: list[int]) -> int:
    """Longest common subsequence of an item and any stretch of ``here`` of up to 1.5 times its length, in hops."""
    width = stretch(n)
    if len(here) <= width:
        return lcs_length(n, at, here)
    hop = max(1, n // 3)
    return max(lcs_length(n, at, here[s:s + width]) for s in range(0, len(here) - width + hop, hop))


def item_slices(benchmark: DataFrame, id_col: str, text_col: str, min_words: int,
                max_words: int = MAX_ITEM_WORDS) -> Iterator[Items]:
    """The benchmark's items in slices of at most about ``max_words`` words, read one after the other."""
    held: list[tuple] = []
    size = 0
    for r in benchmark.select(id_col, text_col).orderBy(id_col, text_col).toLocalIterator():
        text = r[1] or ""
        held.append((r[0], text))
        size += text.count(" ") + text.count("\n") + 1
        if size >= max_words:
            yield items_of(held, min_words)
            held, size = [], 0
    if held:
        yield items_of(held, min_words)


@dataclass(frozen=True)
class Rule:
    """Thresholds: cosine of candidates; share of an item's words for a copy, for a paraphrase; share of its answer."""

    min_words: int = 8
    min_cosine: float = 0.4
    copy: float = 0.8
    paraphrase: float = 0.6
    answer: float = 0.6

    def judge(self, column: pa.Array, items: Items, space: Space | None) -> dict[int, list[tuple[float, float, int, int]]]:
        out: dict[int, list[tuple[float, float, int, int]]] = {}
        if space is not None:
            weight = (space.idf[:, None] * space.basis).astype(np.float32)
            out = judge_batch(column, items, space, weight, self.min_cosine, self.paraphrase, self.copy, self.answer)
        for r, item, at in short_hits(column, items):
            out.setdefault(r, []).append((1.0, 1.0, item, at))
        return out

    def kind(self, share: float) -> str:
        return "copy" if share >= self.copy else "paraphrase"


def spaces(docs: DataFrame, benchmark: DataFrame, text_col: str, item_col: str, item_text_col: str,
           rule: Rule) -> Iterator[tuple[Items, Space | None]]:
    """The benchmark in slices, each with its latent space over all documents (None where all its items are short)."""
    for items in item_slices(benchmark, item_col, item_text_col, rule.min_words):
        if items.ids:
            yield items, latent_space(docs, items, text_col, min(rule.paraphrase, rule.copy)) if items.words else None


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text_col: str = "text", rule: Rule = Rule()) -> DataFrame:
    """Pairs of a document and an item that it holds: ``id_col, item_id, coverage, answered, first_word, kind``."""
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType),
                           T.StructField("item_id", benchmark.schema[item_col].dataType),
                           T.StructField("coverage", T.DoubleType()), T.StructField("answered", T.DoubleType()),
                           T.StructField("first_word", T.LongType()), T.StructField("kind", T.StringType())])
    arrow = output_type(schema)
    own = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    out = own.limit(0).mapInArrow(lambda batches: iter(()), schema)
    for items, space in spaces(docs, benchmark, text_col, item_col, item_text_col, rule):

        def run(batches: Iterable[pa.RecordBatch], items: Items = items, space: Space | None = space) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = [(r, items.ids[i], share, told, at, rule.kind(share))
                        for r, found in sorted(rule.judge(batch.column(1), items, space).items())
                        for share, told, i, at in found]
                if rows:
                    cols = list(map(list, zip(*rows, strict=True)))
                    yield record_batch(arrow, batch.column(0).take(pa.array(cols[0])), *cols[1:])

        out = out.unionByName(own.mapInArrow(run, schema))
    return out


def remove_leaked(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", rule: Rule = Rule()) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no item; decided where a row lies, without a join."""
    out, at = docs, docs.columns.index(text_col)
    for items, space in spaces(docs, benchmark, text_col, item_col, item_text_col, rule):

        def run(batches: Iterable[pa.RecordBatch], items: Items = items, space: Space | None = space,
                at: int = at) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                keep[list(rule.judge(batch.column(at), items, space))] = False
                yield batch.filter(pa.array(keep))

        out = out.mapInArrow(run, docs.schema)
    return out


def judged(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", rule: Rule = Rule()) -> DataFrame:
    """One row per row of ``docs``, decided where it lies: ``id_col, leaked, item_id, coverage, kind, n_items``.

    ``item_id`` is the item with the largest coverage, of equal ones the
    smallest id; ``n_items`` counts different items.
    """
    result = T.StructType([T.StructField("leaked", T.BooleanType()), T.StructField("item_id", benchmark.schema[item_col].dataType),
                           T.StructField("coverage", T.DoubleType()), T.StructField("kind", T.StringType()),
                           T.StructField("n_items", T.LongType())])
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("_text", T.StringType()), *result])
    arrow = output_type(schema)
    out = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text"),
                      *[F.lit({"leaked": False, "n_items": 0}.get(f.name)).cast(f.dataType).alias(f.name) for f in result])
    for items, space in spaces(docs, benchmark, text_col, item_col, item_text_col, rule):

        def run(batches: Iterable[pa.RecordBatch], items: Items = items, space: Space | None = space) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                cols = [c.to_pylist() for c in batch.columns[2:]]
                for r, found in rule.judge(batch.column(1), items, space).items():
                    best = min((-share, items.ids[i] is None, items.ids[i] or 0) for share, _, i, _ in found)
                    old = (-(cols[2][r] or 0.0), cols[1][r] is None, cols[1][r] or 0)
                    cols[0][r] = True
                    cols[4][r] += len({items.ids[i] for _, _, i, _ in found})  # slices have different items
                    if best < old:
                        cols[1][r] = None if best[1] else best[2]
                        cols[2][r], cols[3][r] = -best[0], rule.kind(-best[0])
                yield record_batch(arrow, batch.column(0), batch.column(1), *cols)

        out = out.mapInArrow(run, schema)
    return out.drop("_text")
