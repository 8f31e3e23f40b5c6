"""Near-duplicate documents by order MinHash.

Two texts are linked if the edit distance of their word sequences is at most
(1 - similarity) of the longer one, found by an alignment in a band. Classes
are the components of links.

Candidates come from sketches. A text's k-mers are its runs of ``K_WORDS``
words, each with its occurrence number. A sketch takes, for one hash order,
the smallest labelled k-mers (three in most sketches) and keeps the order in
which they stand in the text, so texts with the same k-mers in another order
don't share it. Short k-mers are needed for a similarity of 0.8: every fifth
word may differ there, which leaves no run of five words equal, but 43 % of
the pairs of words. Three of them in order are as selective as a run of six
words. ``FAMILIES`` adds sketches of two k-mers and of one for short texts.

Recall at similarity 0.8, the worst case: with every fifth word changed a
pair has Jaccard similarity 0.43 and shares one of the 66 sketches of three
with probability 1 - (1 - 0.43**3)**66 > 0.99, and with more, the more alike
it is (0.999 with a tenth of the words changed). Tests hold this against all
pairs for texts of 5 to 400 words.

Exact copies (same words in the same order) are one node from the start, so
a group of copies costs its size once. In a bucket of up to ``SMALL`` nodes
all are compared, in a larger one each with three members (one by hash,
smallest and largest), beyond ``HOT`` nodes with the one by hash, which is the
same in many buckets. That joins a large group of near copies in work linear
in its size, and it is only the first round: in the second, all nodes of a
large bucket whose members are not one class by then are compared with each
other, but for pairs within a class and pairs that exact bounds rule out
(``near_in_blocks``). So no pair that shares a bucket is lost, whatever its size,
and ``SMALL`` and ``HOT`` decide only what is compared first. What many texts
share (a boilerplate) makes large buckets; the bound sets texts apart by their
own words, so only texts that may well be alike cost a comparison.

Defined cases
* null text, and a text without words: a class of its own, never linked.
* texts of fewer than two words have one k-mer, the whole.
* case and everything but letters and digits don't count: such texts are copies.
* a null id gets a null class; an id that repeats belongs to the smallest of its classes' ids.
* ties are broken by the smallest id; an empty table gives an empty table.
* columns besides id and text are dropped.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabspark.llm.graph import components
from tabspark.llm.tasks import output_type, pieces, record_batch, stored
from tabspark.llm.text import Words, mix, shingles

K_WORDS, SIMILARITY = 2, 0.8
#: Sketches: (labelled k-mers of each, how many, for texts of up to so many words; None: all).
FAMILIES = ((3, 66, None), (2, 20, 64), (1, 10, 9))
#: Nodes of a bucket that are all compared with each other; nodes from which one centre stands for a bucket, not three.
SMALL, HOT = 4, 64


def _multipliers(n: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)) | np.uint64(1)


def occurrence_labelled(kmer: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Hashes of (k-mer, how often it stood before in its row)."""
    if not len(kmer):
        return kmer
    with np.errstate(over="ignore"):
        own = mix(kmer ^ (row.astype(np.uint64) + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F))
    order = np.argsort(own, kind="stable")  # text order within equal k-mers of a row
    new = np.ones(len(kmer), bool)
    new[1:] = own[order][1:] != own[order][:-1]
    at = np.arange(len(kmer))
    nth = np.empty(len(kmer), np.uint64)
    nth[order] = (at - np.maximum.accumulate(np.where(new, at, 0))).astype(np.uint64)
    with np.errstate(over="ignore"):
        return mix(kmer + nth * np.uint64(0x9E3779B97F4A7C15))


def sketches(kmer: np.ndarray, label: np.ndarray, row: np.ndarray, first: np.ndarray, picks: int,
             multipliers: np.ndarray) -> np.ndarray:
    """(rows, sketches) order-MinHash keys of ``picks`` labelled k-mers each; rows without k-mers get zeros."""
    count = np.diff(first)
    rows = np.flatnonzero(count > 0)
    out = np.zeros((len(count), len(multipliers)), np.uint64)
    if not len(rows):
        return out
    # A row's smallest values lie below a bound that some of its k-mers meet; rows with too few meet none.
    bound = np.minimum(1.0, (picks + 8) / np.maximum(count, 1))
    limit = np.where(bound >= 1, np.iinfo(np.uint64).max, (bound * 2.0**64 * 0.999).astype(np.uint64))
    limit_of = limit[row]
    least = np.minimum(count[rows], picks)
    with np.errstate(over="ignore"):
        for s, m in enumerate(multipliers):
            x = label * m
            low = x <= limit_of
            for r in rows[np.add.reduceat(low, first[rows], dtype=np.int64) < least]:
                low[first[r]:first[r + 1]] = True
            some = np.flatnonzero(low)
            # By row, then by the first 40 bits of the hash.
            some = some[np.argsort((row[some].astype(np.uint64) << np.uint64(40)) | (x[some] >> np.uint64(24)), kind="stable")]
            start = np.searchsorted(row[some], rows)
            # A row with fewer k-mers takes all of them, the last one as often as needed.
            taken = np.stack([some[start + np.minimum(t, least - 1)] for t in range(picks)])
            key = np.full(len(rows), np.uint64(s) ^ m)
            for at in np.sort(taken, axis=0):
                key = mix((key ^ kmer[at]) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(picks))
            out[rows, s] = key
    return out


def all_keys(words: Words, k: int, families: tuple = FAMILIES) -> tuple[np.ndarray, np.ndarray]:
    """(keys, offsets): every row's sketches of all families that its number of words calls for."""
    kmer, row, first = shingles(words, k)
    label = occurrence_labelled(kmer, row)
    n_words = np.diff(words.first)
    parts, owner, used = [], [], 0
    for picks, n, most in families:
        own = (n_words > 0) if most is None else (n_words > 0) & (n_words <= most)
        rows = np.flatnonzero(own)
        m = _multipliers(used + n)[used:]
        used += n
        if not len(rows):
            continue
        keep = own[row]
        size = np.where(own, np.diff(first), 0)
        keys = sketches(kmer[keep], label[keep], row[keep], np.concatenate([[0], np.cumsum(size)]), picks, m)[rows]
        parts.append(keys.ravel())
        owner.append(np.repeat(rows, n))
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(len(n_words) + 1, np.int64)
    keys, owner = np.concatenate(parts), np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    return keys[order], np.searchsorted(owner[order], np.arange(len(n_words) + 1))


def sequence_keys(words: Words) -> list[bytes | None]:
    """128-bit hash of each row's word sequence; None for a row without words."""
    count = np.diff(words.first)
    rows = np.flatnonzero(count > 0)
    out: list[bytes | None] = [None] * len(count)
    if not len(rows):
        return out
    at = np.arange(len(words.hash)) - words.first[:-1][words.row]
    halves = []
    with np.errstate(over="ignore"):
        for base in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F):
            power = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(count.max(), base, np.uint64)]))
            h = mix(words.hash ^ np.uint64(base))
            total = np.add.reduceat(h * power[at], words.first[:-1][rows])
            halves.append(mix(total ^ count[rows].astype(np.uint64)))
    for r, pair in zip(rows, np.stack(halves, 1).astype(">u8"), strict=True):
        out[r] = pair.tobytes()
    return out


def banded_distance(a: Sequence[int], b: Sequence[int], limit: int) -> int | None:
    """Edit distance of two sequences if it is at most ``limit``, else None.

    Only diagonals that can still end in time are followed: for each number
    of edits, the furthest row reached on each diagonal of the band.
    """
    n, m = len(a), len(b)
    if abs(n - m) > limit:
        return None
    goal = m - n
    far = {}
    for e in range(limit + 1):
        new = {}
        for k in range(max(-e, goal - limit + e), min(e, goal + limit - e) + 1):
            if e == 0:
                i = 0
            else:
                i = max(far.get(k, -2) + 1, far.get(k - 1, -2), far.get(k + 1, -2) + 1)
                if i < 0:
                    continue
                i = min(i, n, m - k)
                if i < 0 or i + k < 0:
                    continue
            while i < n and i + k < m and a[i] == b[i + k]:
                i += 1
            if k == goal and i >= n:
                return e
            new[k] = i
        far = new
    return None


def wide_banded_distance(a: np.ndarray, b: np.ndarray, limit: int) -> int | None:
    """As ``banded_distance``; all diagonals of the band go on at once, for long sequences with many edits."""
    n, m = len(a), len(b)
    goal = m - n
    if abs(goal) > limit:
        return None
    stretch = np.arange(STRETCH)
    left, right = (np.concatenate([x, np.zeros(STRETCH + 1, x.dtype)]) for x in (a, b))
    k = np.arange(-limit, limit + 1)  # diagonals; far: the furthest row reached on each, -2 for none
    far = np.full(len(k) + 2, -2, np.int64)
    for e in range(limit + 1):
        lo, hi = max(-e, goal - limit + e, -limit), min(e, goal + limit - e, limit)
        if lo > hi:
            return None
        at = slice(lo + limit, hi + limit + 1)
        d = k[at]
        if e:
            i = np.maximum(np.maximum(far[1:-1][at] + 1, far[:-2][at]), far[2:][at] + 1)
            i = np.minimum(np.minimum(i, n), m - d)
            i[(i < 0) | (i + d < 0)] = -2
        else:
            i = np.zeros(1, np.int64)
        go = np.flatnonzero(i >= 0)
        while len(go):  # equal words from each diagonal's row on, a stretch at a time
            x = i[go]
            differ = left[x[:, None] + stretch] != right[(x + d[go])[:, None] + stretch]
            whole = ~differ.any(axis=1)
            end = np.minimum(n, m - d[go])
            i[go] = np.minimum(x + np.where(whole, len(stretch), differ.argmax(axis=1)), end)
            go = go[whole & (i[go] < end)]
        if lo <= goal <= hi and i[goal - lo] >= n:
            return e
        new = np.full(len(far), -2, np.int64)
        new[1:-1][at] = i
        far = new
    return None


#: Edits from which an alignment follows all diagonals at once, and words that it compares of each at once.
WIDE, STRETCH = 64, 12


def alike(a: np.ndarray, b: np.ndarray, similarity: float) -> float | None:
    """1 - edit distance / longer length of two word sequences if that is at least ``similarity``."""
    longer = max(len(a), len(b))
    limit = int((1 - similarity) * longer + 1e-9)
    if not longer or longer - min(len(a), len(b)) > limit:
        return None
    short = min(len(a), len(b))
    differ = np.flatnonzero(a[:short] != b[:short])
    lead = int(differ[0]) if len(differ) else short
    a, b = a[lead:], b[lead:]
    short -= lead
    if short:
        differ = np.flatnonzero(a[::-1][:short] != b[::-1][:short])
        tail = int(differ[0]) if len(differ) else short
        a, b = a[:len(a) - tail], b[:len(b) - tail]
    # Words in common, with their numbers, bound the distance from below.
    ua, ca = np.unique(a, return_counts=True)
    ub, cb = np.unique(b, return_counts=True)
    _, ia, ib = np.intersect1d(ua, ub, assume_unique=True, return_indices=True)
    if max(len(a), len(b)) - int(np.minimum(ca[ia], cb[ib]).sum()) > limit:
        return None
    d = banded_distance(a.tolist(), b.tolist(), min(limit, WIDE))
    if d is None and limit > WIDE:
        d = wide_banded_distance(a, b, limit)
    return None if d is None else 1 - d / longer


# -------------------------------------------------------------- Spark jobs

def _fingerprints(families: tuple, k: int, schema: pa.Schema):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 1):
            words = Words(batch.column(1))
            keys, offsets = all_keys(words, k, families)
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(keys.view(np.int64)))
            yield record_batch(schema, batch.column(0), sequence_keys(words), lists, pa.array(np.diff(words.first)),
                               signatures(words, 1), signatures(words, k))

    return run


def _node_hashes(schema: pa.Schema):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 1):
            yield record_batch(schema, batch.column(0), sequence_keys(Words(batch.column(1))))

    return run


def _sequences(schema: pa.Schema):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 1):
            words = Words(batch.column(1))
            yield record_batch(schema, batch.column(0),
                               [words.hash[words.first[i]:words.first[i + 1]].tobytes() for i in range(len(batch))])

    return run


def _verify(similarity: float, schema: pa.Schema):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for c, m, wc, wm in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                s = alike(np.frombuffer(wc, np.uint64), np.frombuffer(wm, np.uint64), similarity)
                if s is not None:
                    rows.append((c, m, s))
            if rows:
                yield record_batch(schema, *map(list, zip(*rows, strict=True)))

    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k_words: int = K_WORDS,
                    families: tuple = FAMILIES, similarity: float = SIMILARITY) -> DataFrame:
    """One row per input row: ``id_col, class_id, kept`` (class_id: the smallest id of its class)."""
    id_type = docs.schema[id_col].dataType
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([T.StructField("id", id_type), T.StructField("node", T.BinaryType()),
                           T.StructField("keys", T.ArrayType(T.LongType())), *MARK.fields[1:]])
    marked = own.mapInArrow(_fingerprints(families, k_words, output_type(schema)), schema)
    # A node is a number from here on: 8 bytes instead of the 16 of its words' hash.
    nodes = stored(marked.where(F.col("node").isNotNull()).groupBy(F.col("node").alias("hash"))
                   .agg(F.min("id").alias("rep"), *(F.first(c).alias(c) for c in ("keys", *MARK.names[1:])))
                   .withColumn("node", F.monotonically_increasing_id()))
    # A repeated id may have other texts besides: the words must be the node's own.
    repeats = id_repeats(nodes)
    met = stored(meetings(nodes.select(F.explode("keys").alias("bucket"), "node")))
    marks = nodes.select(*MARK.names)
    pairs = stored(maybe_alike(candidate_pairs(met), marks, k_words, similarity))
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    ids = wanted.join(nodes.select("node", "rep", "hash"), "node")
    links = _links(pairs, ids, node_words(own, ids, repeats), id_type, similarity)
    # Graph nodes carry their smallest id in front (null last), so a component's smallest node has its class.
    labels = stored(components(links.select("a", "b")))
    apart = stored(unsettled(met, labels.select("node.node", F.col("component.node").alias("class"))))
    if not apart.isEmpty():
        more = stored(pairs_in_blocks(marks, apart, k_words, similarity).join(pairs, ["a", "b"], "left_anti"))
        ids = more.select(F.col("a").alias("node")).union(more.select("b")).distinct().join(nodes.select("node", "rep", "hash"), "node")
        links = _links(more, ids, node_words(own, ids, repeats), id_type, similarity, -(-more.count() // ALIGNED)).select("a", "b")
        # A class is its nodes' links to the smallest.
        labels = components(links.union(labels.select("node", "component")))
    labels = labels.withColumnRenamed("node", "named")
    classes = nodes.select(named("rep", "node").alias("named"), "hash", "rep").join(labels.hint("merge"), "named", "left").select(
        "hash", F.coalesce("component.rep", "rep").alias("class_id"))
    # Hashed again: a table of every row's sketches would be larger than the texts.
    named_rows = T.StructType([T.StructField("id", id_type), T.StructField("hash", T.BinaryType())])
    out = (own.mapInArrow(_node_hashes(output_type(named_rows)), named_rows).join(classes.hint("merge"), "hash", "left")
           .select("id", F.coalesce("class_id", "id").alias("class_id")))
    return out.select(F.col("id").alias(id_col), F.when(F.col("id").isNotNull(), F.col("class_id")).alias("class_id"),
                      F.coalesce(F.col("id") == F.col("class_id"), F.lit(False)).alias("kept"))


def meetings(member: DataFrame) -> DataFrame:
    """``(a, b, bucket)`` from ``(bucket, node)``: the pairs of small buckets (``bucket`` null), and each node ``b`` of a
    large one with its one or three centres ``a``, itself perhaps."""
    # Most buckets have one node; both are written, so that partitions of a bucket with very many members can be split.
    shared = stored(member.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket"))
    member = stored(member.join(shared, "bucket", "left_semi"))
    turned = F.struct(F.xxhash64("node").alias("h"), F.col("node").alias("node"))
    buckets = stored(member.groupBy("bucket")
                     .agg(F.count("*").alias("n"), F.min("node").alias("c1"), F.max("node").alias("c2"),
                          F.min(turned)["node"].alias("c3")))
    met = member.join(buckets, "bucket")
    few = (met.where(F.col("n") <= SMALL).groupBy("bucket").agg(F.array_sort(F.collect_set("node")).alias("m"))  # SMALL at most
           .select(F.explode(F.flatten(F.transform("m", lambda a: F.transform(
               F.filter("m", lambda b: b > a), lambda b: F.struct(a.alias("a"), b.alias("b")))))).alias("p")).select("p.*"))
    many = (met.where(F.col("n") > SMALL)
            .select(F.explode(F.when(F.col("n") > HOT, F.array("c3")).otherwise(F.array_distinct(F.array("c1", "c2", "c3"))))
                    .alias("a"), F.col("node").alias("b"), "bucket"))
    return few.select("a", "b", F.lit(None).cast("long").alias("bucket")).unionByName(many)


def candidate_pairs(met: DataFrame) -> DataFrame:
    """The different pairs ``(a, b)``, a < b, of ``meetings``, to be compared first."""
    return met.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def unsettled(met: DataFrame, classes: DataFrame) -> DataFrame:
    """``(bucket, node, class)`` of the large buckets that hold more than one class, numbered; ``classes`` has the nodes with
    links."""
    member = (met.where("bucket is not null").select("bucket", F.col("b").alias("node")).distinct()
              .join(classes, "node", "left").withColumn("class", F.coalesce("class", "node")))
    mixed = member.groupBy("bucket").agg(F.min("class").alias("x"), F.max("class").alias("y")).where("x < y")
    mixed = stored(mixed.select("bucket", F.monotonically_increasing_id().alias("no")))  # most bits alike, unlike a key's
    return member.join(mixed, "bucket").select(F.col("no").alias("bucket"), "node", "class")


#: Pairs of the second round that a task aligns.
ALIGNED = 2000
#: Cells that k-mers fall into by hash, counted for ``prefixes``.
CELL_BITS = 18
#: k-mers that two texts must have in common in their prefixes, and the share of those that they share at least added to it.
COMMON, COMMON_SHARE = 3, 0.05


class _Sequences:
    """Word hashes of a column of ``node_words``, in the form of ``Words``."""

    def __init__(self, column: pa.Array):
        rows = column.to_pylist()
        self.hash = np.frombuffer(b"".join(rows), np.uint64)
        self.first = np.concatenate([[0], np.cumsum([len(r) // 8 for r in rows], dtype=np.int64)]).astype(np.int64)


def least_shared(n_words: np.ndarray, k: int, similarity: float) -> np.ndarray:
    """How many labelled k-mers a text of so many words shares at least with any text that is as alike.

    An edit touches k k-mers, so texts at edit distance d, the longer of n
    words, share n - k + 1 - k d; d and n are what the similarity allows.
    """
    n = np.arange(int(n_words.max(initial=1) / similarity) + 3)
    shared = n - k + 1 - k * ((1 - similarity) * n + 1e-9).astype(np.int64)
    longest = (n_words / similarity).astype(np.int64) + 2
    sizes, back = np.unique(np.stack([n_words, longest], 1), axis=0, return_inverse=True)
    return np.array([shared[a:b].min() for a, b in sizes], np.int64)[back.ravel()] if len(sizes) else np.zeros(0, np.int64)


def prefix_lengths(n_words: np.ndarray, k: int, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """(lengths, spare): how many k-mers a prefix of a text of so many words has, and how many fewer than the text (0 or less).

    Of two texts that share t of their k-mers, put in one order, the first
    (size - t + c) of each have c in common, c at most t. So two texts that
    share t have the smaller ``spare`` + t in common in their prefixes.
    """
    size = np.where(n_words >= k, n_words - k + 1, (n_words > 0).astype(np.int64))
    t = np.maximum(least_shared(n_words, k, similarity), 1)
    common = np.minimum(COMMON + (COMMON_SHARE * t).astype(np.int64), t)
    length = np.minimum(size - t + common, size)
    return length, length - size


def prefixes(words: _Sequences, k: int, similarity: float, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(keys, offsets): each row's rarest labelled k-mers, as many as ``prefix_lengths`` says.

    The order is by the cells' counts, then by hash. Where a text need share
    none, it has the key 0 besides.
    """
    kmer, row, first = shingles(words, k)
    label = occurrence_labelled(kmer, row)
    n_words, size = np.diff(words.first), np.diff(first)
    length, _ = prefix_lengths(n_words, k, similarity)
    order = np.lexsort((label, counts[label >> np.uint64(64 - CELL_BITS)], row))
    rank = np.arange(len(row)) - first[:-1][row]
    keep = rank < length[row]
    none = np.flatnonzero((least_shared(n_words, k, similarity) <= 0) & (size > 0))
    keys = np.concatenate([label[order][keep], np.zeros(len(none), np.uint64)])
    owner = np.concatenate([row[keep], none])
    back = np.argsort(owner, kind="stable")
    return keys[back], np.searchsorted(owner[back], np.arange(len(size) + 1))


#: Bits of a signature per word at most (half as many at least), and its least and most bits (powers of two); nodes of a block, about.
SIGNATURE_BITS, LEAST_BITS, MOST_BITS, BLOCK = 4, 256, 1 << 15, 1024
#: A node's number of words, and its signatures by words and by k-mers.
MARK = T.StructType([T.StructField("node", T.LongType()), T.StructField("n", T.LongType()),
                     T.StructField("words", T.BinaryType()), T.StructField("kmers", T.BinaryType())])


def signatures(words: Words | _Sequences, k: int) -> list[bytes]:
    """Each row's labelled k-mers as bits: a bit says whether an odd number of them falls there by hash.

    Two signatures differ in no more bits than the rows have k-mers that are
    not in both. A longer text has a longer one, which folds to half its bits
    by xor of its halves.
    """
    kmer, row, _ = shingles(words, k)
    label = occurrence_labelled(kmer, row)
    n_words = np.diff(words.first)
    bits = np.left_shift(1, np.floor(np.log2(np.maximum(SIGNATURE_BITS * n_words, 1))).astype(np.int64))
    bits = np.clip(bits, LEAST_BITS, MOST_BITS)
    start = np.concatenate([[0], np.cumsum(bits)])
    at = start[:-1][row] + (label & (bits[row] - 1).astype(np.uint64)).astype(np.int64)
    packed = np.zeros(start[-1] // 64, np.uint64)
    np.bitwise_xor.at(packed, at >> 6, np.uint64(1) << (at & 63).astype(np.uint64))
    packed = packed.tobytes()
    return [packed[i // 8:j // 8] for i, j in zip(start, start[1:])]


def maybe_alike(pairs: DataFrame, marks: DataFrame, k: int, similarity: float) -> DataFrame:
    """The pairs ``(a, b)`` that the bounds of ``near_in_blocks`` leave, so that others' words needn't be brought together."""
    for end in "ab":
        pairs = pairs.join(marks.select(*(F.col(c).alias(end if c == "node" else c + end) for c in MARK.names)), end)
    pair = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = (batch.column(i).to_numpy() for i in (2, 5))
            longer = np.maximum(n, m)
            limit = ((1 - similarity) * longer + 1e-9).astype(np.int64)
            keep = longer - np.minimum(n, m) <= limit
            for left, right, size in ((3, 6, 1), (4, 7, k)):
                need = np.maximum(longer - size + 1 - size * limit, 0)
                most = np.maximum(n - size + 1, 1) + np.maximum(m - size + 1, 1) - 2 * need
                x, y = (batch.column(i).to_pylist() for i in (left, right))
                for i in np.flatnonzero(keep):
                    p, q = (np.frombuffer(z, np.uint64)[None] for z in (x[i], y[i]))
                    width = 8 * min(p.shape[1], q.shape[1])
                    keep[i] = np.bitwise_count(_folded(p, width) ^ _folded(q, width)).sum(dtype=np.int64) <= most[i]
            yield batch.select([0, 1]).filter(pa.array(keep)).cast(output_type(pair))

    return pairs.select("a", "b", *(c + end for end in "ab" for c in MARK.names[1:])).mapInArrow(run, pair)


class _Block:
    """Nodes of a bucket with their classes, numbers of words and signatures, sorted by the signatures' length."""

    def __init__(self, rows: Sequence[dict], bucket: int):
        rows = sorted(rows, key=lambda r: len(r["words"]))
        self.node, self.cls, self.n = (np.array([r[c] for r in rows], np.int64) for c in ("node", "class", "n"))
        #: Buckets that were compared or will be in another place, of smaller numbers.
        self.before = [frozenset(b for b in r["buckets"] if b < bucket) for r in rows]
        width = np.array([len(r["words"]) for r in rows], np.int64)
        #: For each length: which rows, and their signatures by words and by k-mers.
        self.parts = {}
        for w in np.unique(width).tolist():
            lo, hi = np.searchsorted(width, [w, w + 1])
            self.parts[w] = (slice(lo, hi), [np.frombuffer(b"".join(r[c] for r in rows[lo:hi]), np.uint64).reshape(hi - lo, -1)
                                             for c in ("words", "kmers")])


def _folded(bits: np.ndarray, width: int) -> np.ndarray:
    while bits.shape[1] * 8 > width:
        half = bits.shape[1] // 2
        bits = bits[:, :half] ^ bits[:, half:]
    return bits


def near_in_blocks(x: _Block, y: _Block, k: int, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (a, b), a < b, of a node of either block that differ in class and that lengths and signatures leave.

    A pair of several buckets is named in that of the smallest number.
    """
    left, right = [], []
    for wx, (ox, sx) in x.parts.items():
        for wy, (oy, sy) in y.parts.items():
            width = min(wx, wy)
            fx, fy = ([_folded(s, width) for s in side] for side in (sx, sy))
            node, cls, n, before = y.node[oy], y.cls[oy], y.n[oy], y.before[oy]
            for i, (own, c, m, seen) in enumerate(zip(x.node[ox], x.cls[ox], x.n[ox], x.before[ox])):
                longer = np.maximum(n, m)
                limit = ((1 - similarity) * longer + 1e-9).astype(np.int64)
                some = np.flatnonzero((cls != c) & (longer - np.minimum(n, m) <= limit) & ((node > own) if x is y else True))
                # An edit touches one word and k k-mers: texts at that distance have so many in common (``least_shared``).
                for j, size in enumerate((1, k)):
                    if not len(some):
                        break
                    need = np.maximum(longer[some] - size + 1 - size * limit[some], 0)
                    apart = np.maximum(n[some] - size + 1, 1) + max(m - size + 1, 1) - 2 * need
                    some = some[np.bitwise_count(fy[j][some] ^ fx[j][i]).sum(axis=1, dtype=np.int64) <= apart]
                if seen:
                    some = some[[seen.isdisjoint(before[j]) for j in some]]
                left.append(np.full(len(some), own))
                right.append(node[some])
    a, b = (np.concatenate(z) if z else np.zeros(0, np.int64) for z in (left, right))
    return np.minimum(a, b), np.maximum(a, b)


def further_pairs(texts: DataFrame, k: int, similarity: float) -> DataFrame:
    """All pairs ``(a, b)``, a < b, of ``(node, words, class)`` in different classes that the bounds of ``near_in_blocks``
    leave: all texts are one bucket."""

    def signed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 1):
            words = _Sequences(batch.column(1))
            yield record_batch(output_type(MARK), batch.column(0), pa.array(np.diff(words.first)), signatures(words, 1),
                               signatures(words, k))

    member = texts.select(F.lit(0).cast("long").alias("bucket"), "node", "class")
    return pairs_in_blocks(texts.select("node", "words").mapInArrow(signed, MARK), stored(member), k, similarity)


def pairs_in_blocks(marks: DataFrame, member: DataFrame, k: int, similarity: float) -> DataFrame:
    """All pairs ``(a, b)``, a < b, of nodes that share a bucket of ``member`` (bucket, node, class; stored), differ in
    class and are left by the bounds of ``near_in_blocks``, each once.

    A bucket's nodes are dealt to blocks of about ``BLOCK``; a class with more nodes in a bucket has blocks of its own,
    which are not compared with each other. A task compares two blocks, so a bucket of any size is shared by many.
    """
    own = member.groupBy("node").agg(F.collect_list("bucket").alias("buckets"))  # one per sketch at most
    marks = stored(marks.join(own, "node"))
    sizes = member.groupBy("bucket", "class").agg(F.count("*").alias("size")).withColumn(
        "own", F.when(F.col("size") > BLOCK, F.col("class")))
    rest = sizes.groupBy("bucket").agg(F.sum(F.when(F.col("own").isNull(), F.col("size"))).alias("rest"),
                                        (F.sum("size") > BLOCK).alias("several"))
    sizes = sizes.join(rest, "bucket").select(
        "bucket", "class", "own", "several", F.ceil(F.when(F.col("own").isNull(), F.col("rest")).otherwise(F.col("size")) / BLOCK).alias("of"))
    # Both sides are written, so that a class with very many nodes in a bucket can be split.
    dealt = member.join(stored(sizes), ["bucket", "class"]).select(
        "bucket", "own", "several", F.pmod(F.xxhash64("node"), F.col("of")).alias("no"), "node", "class")
    blocks = stored(dealt.join(marks, "node").groupBy("bucket", "own", "several", "no")
                    .agg(F.collect_list(F.struct("class", "buckets", *MARK.names)).alias("rows"))  # about BLOCK
                    .withColumn("block", F.monotonically_increasing_id()))
    more = blocks.where("several")
    ends = {c: more.select(F.col("block").alias(c), "bucket", F.col("own").alias(f"own_{c}")) for c in "xy"}
    two = ends["x"].join(ends["y"], "bucket").where("x < y and not coalesce(own_x = own_y, false)").select("bucket", "x", "y")
    both = (two.join(more.select(F.col("block").alias("x"), F.col("rows").alias("left")), "x")
            .join(more.select(F.col("block").alias("y"), F.col("rows").alias("right")), "y").select("bucket", "left", "right"))
    alone = blocks.where("own is null").select("bucket", F.col("rows").alias("left"), F.lit(None).cast(blocks.schema["rows"].dataType).alias("right"))
    pair = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])

    def compared(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                bucket, left, right = (column[at].as_py() for column in batch.columns)
                x = _Block(left, bucket)
                a, b = near_in_blocks(x, x if right is None else _Block(right, bucket), k, similarity)
                if len(a):
                    yield record_batch(output_type(pair), pa.array(a), pa.array(b))

    return alone.unionByName(both).mapInArrow(compared, pair)


def node_words(own: DataFrame, ids: DataFrame, repeats: bool) -> DataFrame:
    """``(node, words)`` of the nodes of ``ids`` (node, rep, hash); ``repeats``: an id may have several texts."""
    words = T.StructType([T.StructField("node", T.LongType()), T.StructField("words", T.BinaryType())])
    if repeats:
        return _own_words(own, ids.select("node", "hash"), words)
    return (own.join(ids.select(F.col("rep").alias("id"), "node"), "id").select("node", "text")
            .mapInArrow(_sequences(output_type(words)), words))


def _links(pairs: DataFrame, ids: DataFrame, texts: DataFrame, id_type: T.DataType, similarity: float,
           tasks: int = 0) -> DataFrame:
    """``(a, b, similarity)`` of the pairs that are alike, each end with its smallest id; ``tasks``: aligned in so many."""
    point = T.StructType([T.StructField("none", T.BooleanType()), T.StructField("rep", id_type),
                        T.StructField("node", T.LongType())])
    link = T.StructType([T.StructField("a", point), T.StructField("b", point), T.StructField("similarity", T.DoubleType())])
    texts = texts.join(ids.select("node", "rep"), "node").select("node", named("rep", "node").alias("n"), "words")
    for end in "ab":
        pairs = pairs.join(texts.select(F.col("node").alias(end), F.col("n").alias(f"n{end}"), F.col("words").alias(f"w{end}")), end)
    both = pairs.select("na", "nb", "wa", "wb")
    both = both.repartition(tasks) if tasks else both  # few bytes may be many alignments
    return both.mapInArrow(_verify(similarity, output_type(link)), link)


def named(rep: str, node: str) -> Column:
    return F.struct(F.col(rep).isNull().alias("none"), F.col(rep).alias("rep"), F.col(node).alias("node"))


def id_repeats(nodes: DataFrame) -> bool:
    """Whether the smallest id of one node is also that of another."""
    return not nodes.groupBy("rep").agg(F.count("*").alias("n")).where("n > 1 or rep is null").isEmpty()


def _own_words(own: DataFrame, wanted: DataFrame, words: T.StructType) -> DataFrame:
    """The word sequences of the wanted nodes, found by their texts rather than by their ids."""
    keyed = T.StructType([T.StructField("hash", T.BinaryType()), T.StructField("text", T.StringType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 0):
            yield record_batch(output_type(keyed), sequence_keys(Words(batch.column(0))), batch.column(0))

    rows = own.select("text").mapInArrow(run, keyed).join(wanted, "hash").groupBy("node").agg(
        F.min("text").alias("text"))
    return rows.mapInArrow(_sequences(output_type(words)), words)
