"""Repeated byte strings by suffix order: every string of ``length`` bytes that occurs more than once.

Texts are UTF-8 bytes; strings never cross documents and are judged on the
input. ``keep="none"`` removes every byte covered by a repeated string,
``keep="first"`` leaves the first occurrence (documents in the order of a
hash of id and text, then by position).

1. A string's anchor is the place in it whose next ``GRAM`` bytes have the
   smallest hash (the leftmost of equal ones), so equal strings have equal
   anchors. Consecutive strings with one anchor make a window; a window's
   key is the hash at its anchor. One scan lists (key, window hash, document,
   start, number of strings).
2. Keys that occur once are done with. Equal windows of a key are one
   variant with a count; a key with one variant needs no bytes: all its
   strings are repeated.
3. Variants of the other keys are fetched from their first documents. Those
   of a key go to one task, which puts their suffixes in order around the
   anchors. Strings that agree in ``length`` bytes are neighbours in that
   order, and the previous and next smaller positions among them tell which
   have an earlier match (a longest previous factor of at least ``length``)
   and which are one.
   Keys with more than ``MAX_VARIANTS`` variants are split instead: their
   strings are grouped by hashes, one row each, so no group meets in a task.
4. The strings found go back to all members of a variant and, merged per
   document, to the text.

Defined cases
* null counts as empty; texts shorter than ``length`` lose nothing.
* repeated rows (same id and text) are occurrences elsewhere of each other.
* null and repeated ids: every input row gives a row.
* a text of any length is read whole, in pieces that overlap.
* an empty table gives an empty table; columns besides id and text are dropped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabspark.llm.tasks import output_type, record_batch, stored
from tabspark.llm.text import span_hashes, utf8

LENGTH, GRAM = 200, 32
#: Bytes that are scanned, or ordered, at once, about.
PIECE = 4 << 20
#: Variants of a key that one task orders, as many as fit a piece; keys with more are split.
MAX_VARIANTS = PIECE // (2 * LENGTH)
_POS = np.uint64((1 << 24) - 1)


def _eight(data: np.ndarray, order: str) -> np.ndarray:
    """The eight bytes from each position on as an integer; zeros follow the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray((len(data),), f"{order}u8", padded, strides=(1,)).astype(np.uint64)


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A hash of the ``gram`` bytes (a multiple of 8) from each position on."""
    if len(data) < gram:
        return np.zeros(0, np.uint64)
    x = _eight(data, "<")
    n = len(data) - gram + 1
    with np.errstate(over="ignore"):
        h = np.zeros(n, np.uint64)
        for j in range(0, gram, 8):
            h += x[j:j + n]
            h *= np.uint64(0xD6E8FEB86659FD93)
            h ^= h >> np.uint64(32)
        h *= np.uint64(0x9E3779B97F4A7C15)
    return h


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Smallest of the ``width`` values from each position on."""
    have, m = 1, x
    while 2 * have <= width:
        m = np.minimum(m[:-have], m[have:])
        have *= 2
    return np.minimum(m[:len(x) - width + 1], m[width - have:]) if have < width else m


def windows(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH,
            gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, start in row, number of strings, key, hash) of every window of rows of bytes; below 16 MB."""
    count = np.maximum(np.diff(offsets) - length + 1, 0)
    row = np.repeat(np.arange(len(count)), count)
    if not len(row):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    at = offsets[:-1][row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    h = gram_hashes(data, gram)
    least = sliding_min((h & ~_POS) | np.arange(len(h), dtype=np.uint64), length - gram + 1)[at]
    new = np.ones(len(row), bool)
    new[1:] = (least[1:] != least[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(row)))
    start = at[first]
    return (row[first], start - offsets[:-1][row[first]], n, h[(least[first] & _POS).astype(np.int64)],
            span_hashes(data, start, start + n + length - 1))


def pieces(column: pa.Array, overlap: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, offsets, row, start in row) of groups of rows of about PIECE bytes; longer rows come in overlapping parts."""
    data, offsets = utf8(column)
    row, begin, end = [], [], []
    for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        for lo in range(a, max(b - overlap, a + 1), PIECE):
            row.append(i)
            begin.append(lo)
            end.append(min(b, lo + PIECE + overlap))
    at, size = 0, np.array(end, np.int64) - np.array(begin, np.int64)
    while at < len(row):
        to = at + max(1, int(np.searchsorted(np.cumsum(size[at:]), PIECE, side="right")))
        parts = [data[b:e] for b, e in zip(begin[at:to], end[at:to], strict=True)]
        own = np.array(row[at:to])
        yield (np.concatenate(parts), np.concatenate([[0], np.cumsum(size[at:to])]), own,
               np.array(begin[at:to]) - offsets[own])
        at = to


def anchors(data: np.ndarray, offsets: np.ndarray, n: np.ndarray, key: np.ndarray, length: int, gram: int = GRAM) -> np.ndarray:
    """Place in ``data`` of each window's anchor: the first one common to its strings whose gram has the key's hash."""
    h = gram_hashes(data, gram)
    hit = np.flatnonzero(h == np.repeat(key.view(np.uint64), np.diff(offsets))[:len(h)])
    return hit[np.searchsorted(hit, offsets[:-1] + n - 1)]


def contexts(data: np.ndarray, lo: np.ndarray, hi: np.ndarray, width: int, back: bool) -> np.ndarray:
    """The bytes from lo to hi as rows of ``width``, or those before hi backwards; zeros follow the end."""
    step = np.arange(width)
    at = hi[:, None] - 1 - step if back else lo[:, None] + step
    inside = (at >= lo[:, None]) & (at < hi[:, None])
    return np.where(inside, data[np.where(inside, at, 0)], np.uint8(0))


def suffix_order(rows: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of bytes in lexicographic order within their group, and how many bytes each shares with the row before.

    -1 where a group begins.
    """
    width = rows.shape[1] + 8
    rows = np.concatenate([group.astype(">u8").view(np.uint8).reshape(-1, 8), rows], axis=1)
    order = np.argsort(np.ascontiguousarray(rows).view(f"S{width}").ravel(), kind="stable")
    differ = rows[order[1:]] != rows[order[:-1]]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), width) - 8
    return order, np.concatenate([[-1], np.maximum(common, -1)])


def previous_smaller(position: np.ndarray, group: np.ndarray) -> np.ndarray:
    """For each entry, the last one before it in its group whose position is smaller; -1 if there is none.

    All entries follow the same links at once, over ever longer stretches.
    """
    link = np.arange(len(position)) - 1
    link[np.flatnonzero(np.diff(group, prepend=group[:1] - 1 if len(group) else 0))] = -1
    while True:
        go = np.flatnonzero(link >= 0)
        go = go[position[link[go]] >= position[go]]
        if not len(go):
            return link
        link[go] = link[link[go]]


def occurs(data: np.ndarray, offsets: np.ndarray, n: np.ndarray, key: np.ndarray, doc: np.ndarray, start: np.ndarray,
           length: int, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """For each string of windows of whole keys: whether it occurs in another window, and whether it does in an earlier one.

    Equal strings lie alike around equal anchors. So the windows' suffixes
    are put in order from their anchors on, and their prefixes from the
    anchors back; the lengths that neighbours share tell, for strings that
    begin d bytes before the anchor, which agree in d bytes to the left and
    in the rest to the right. Strings in that order are equal neighbours, and
    the previous and next smaller positions among them are their earlier
    matches: a string occurs elsewhere if it has one, or is one.
    """
    m, first = len(n), np.cumsum(n) - n
    at = anchors(data, offsets, n, key, length, gram)
    group = np.unique(key, return_inverse=True)[1]
    right, shared_right = suffix_order(contexts(data, at, offsets[1:], length, False), group)
    left, shared_left = suffix_order(contexts(data, offsets[:-1], at, length - gram, True), group)
    far = at - offsets[:-1]  # of the first string
    a, b = np.empty(m, np.int64), np.empty(m, np.int64)
    code, place = [], []
    for d in range(int(far.max(initial=-1)) + 1):
        own = np.flatnonzero((d <= far) & (far - n < d))
        a[left], b[right] = np.cumsum(shared_left < d), np.cumsum(shared_right < length - d)
        some = (d * (m + 1) + a[own]) * (m + 1) + b[own]
        code.append(some)
        place.append(first[own] + far[own] - d)
    elsewhere, earlier = np.zeros(n.sum(), bool), np.zeros(n.sum(), bool)
    if not code:
        return elsewhere, earlier
    code, place = np.concatenate(code), np.concatenate(place)
    order = np.argsort(code, kind="stable")
    code, place = code[order], place[order]
    same = code[1:] == code[:-1]
    several = np.concatenate([same, [False]]) | np.concatenate([[False], same])
    code, place = code[several], place[several]
    own = np.searchsorted(first, place, side="right") - 1
    position = np.empty(len(place), np.int64)
    position[np.lexsort((start[own] + place - first[own], doc[own]))] = np.arange(len(place))
    before = previous_smaller(position, code)
    after = len(place) - 1 - previous_smaller(position[::-1], code[::-1])[::-1]  # next smaller, from the other end
    has_before, has_after = before >= 0, after < len(place)
    match = np.zeros(len(place), bool)
    match[before[has_before]] = match[after[has_after]] = True
    earlier[place] = has_before | has_after
    elsewhere[place] = has_before | has_after | match
    return elsewhere, earlier


def stretches(flags: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """For each part between offsets the [start, end) of its stretches of true, as a list of pairs."""
    left = np.concatenate([[False], flags[:-1]])
    left[offsets[:-1][offsets[:-1] < len(flags)]] = False
    right = np.concatenate([flags[1:], [False]])
    right[offsets[1:] - 1] = False
    lo, hi = np.flatnonzero(flags & ~left), np.flatnonzero(flags & ~right) + 1
    part = np.searchsorted(offsets, lo, side="right") - 1
    pairs = np.stack([lo - offsets[part], hi - offsets[part]], axis=1).astype(np.int32).ravel()
    inner = pa.ListArray.from_arrays(pa.array(np.arange(0, len(pairs) + 1, 2, dtype=np.int32)), pa.array(pairs))
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(lo, offsets).astype(np.int32)), inner)


# -------------------------------------------------------------- Spark jobs

_RUNS = T.ArrayType(T.ArrayType(T.IntegerType()))
_WINDOW = T.StructType([T.StructField("key", T.LongType()), T.StructField("window", T.LongType()),
                        T.StructField("doc", T.LongType()), T.StructField("start", T.LongType()),
                        T.StructField("n", T.IntegerType())])
_VARIANT = T.StructType([*_WINDOW.fields, T.StructField("copies", T.LongType()), T.StructField("raw", T.BinaryType())])
_RESULT = T.StructType([T.StructField("key", T.LongType()), T.StructField("window", T.LongType()),
                        T.StructField("elsewhere", _RUNS), T.StructField("earlier", _RUNS)])


def _scan(length: int, schema: pa.Schema, keys_only: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs = batch.column(0).to_numpy()
            for data, offsets, rows, begin in pieces(batch.column(1), length - 1):
                row, start, n, key, window = windows(data, offsets, length)
                if not len(row):
                    continue
                if keys_only:
                    some, count = np.unique(key.view(np.int64), return_counts=True)
                    yield record_batch(schema, pa.array(some), pa.array(count))
                else:
                    yield record_batch(schema, pa.array(key.view(np.int64)), pa.array(window.view(np.int64)),
                                       pa.array(docs[rows[row]]), pa.array(start + begin[row]), pa.array(n))

    return run


def _cut(length: int, schema: pa.Schema):
    """Rows (text, wanted windows) -> the windows' bytes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, wanted in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                raw = text.as_py().encode()
                rows += [(w["key"], w["window"], w["doc"], w["start"], w["n"], w["copies"],
                          raw[w["start"]:w["start"] + w["n"] + length - 1]) for w in wanted]
            if rows:
                yield record_batch(schema, *map(list, zip(*rows, strict=True)))

    return run


def _order(length: int, schema: pa.Schema):
    """Rows sorted by key -> for each variant the stretches of strings that occur elsewhere, and before."""

    def solve(rows: pa.Table) -> pa.RecordBatch:
        rows = rows.combine_chunks()
        raw, offsets = utf8(rows.column("raw"))
        n = rows.column("n").to_numpy().astype(np.int64)
        key, doc, begin = (rows.column(c).to_numpy() for c in ("key", "doc", "start"))
        edge = np.append(np.cumsum(n) - n, n.sum())
        some = [stretches(f, edge) for f in occurs(raw, offsets, n, key, doc, begin, length)]
        out = record_batch(schema, rows.column("key").combine_chunks(), rows.column("window").combine_chunks(), *some)
        return out.filter(pc.greater(pc.list_value_length(some[0]), 0))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.nbytes
            if size < PIECE:
                continue
            table = pa.Table.from_batches(held)
            key = table.column("key").to_numpy()
            last = int(np.searchsorted(key, key[-1]))  # the last key may go on in the next batch
            if last:
                yield solve(table.slice(0, last))
            held = table.slice(last).combine_chunks().to_batches()
            size = sum(b.nbytes for b in held) if last else 0
        if held:
            yield solve(pa.Table.from_batches(held))

    return run


_STRING = T.StructType([T.StructField(c, T.LongType()) for c in ("key", "window", "doc", "start", "h1", "h2", "copies")]
                       + [T.StructField("nth", T.IntegerType())])


def _strings(length: int, schema: pa.Schema):
    """Every string of a variant by two hashes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            raw, offsets = utf8(batch.column("raw"))
            n = batch.column("n").to_numpy().astype(np.int64)
            own = np.repeat(np.arange(len(n)), n)
            nth = np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)
            at = offsets[:-1][own] + nth
            h1 = span_hashes(raw, at, at + length).view(np.int64)
            h2 = span_hashes(raw ^ np.uint8(0x5A), at, at + length).view(np.int64)
            col = lambda c: pa.array(batch.column(c).to_numpy()[own])  # noqa: E731, B023
            yield record_batch(schema, col("key"), col("window"), col("doc"),
                               pa.array(batch.column("start").to_numpy()[own] + nth), pa.array(h1), pa.array(h2),
                               col("copies"), pa.array(nth))

    return run


def _ranges(nths: str):
    """Stretches [a, b) of a sorted array of distinct integers, as nested arrays."""
    def add(acc, x):
        last = F.element_at(acc, -1)
        grow = (F.size(acc) > 0) & (F.element_at(last, -1) == x)
        return F.when(grow, F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.array(F.element_at(last, 1), x + 1)))
                      ).otherwise(F.concat(acc, F.array(F.array(x, x + 1))))

    return F.aggregate(F.array_sort(nths), F.array().cast("array<array<int>>"), add)


def _split_keys(variants: DataFrame, length: int) -> DataFrame:
    """What ``_order`` gives, for keys with very many variants: strings grouped by their hashes."""
    rows = variants.mapInArrow(_strings(length, output_type(_STRING)), _STRING)
    place = F.struct("doc", "start")
    groups = rows.groupBy("key", "h1", "h2").agg(F.sum("copies").alias("total"), F.min(place).alias("first"))
    marked = rows.join(groups.where("total > 1"), ["key", "h1", "h2"])
    return (marked.groupBy("key", "window")
            .agg(F.collect_list("nth").alias("e"), F.collect_list(F.when(place != F.col("first"), F.col("nth"))).alias("b"))
            .select("key", "window", _ranges("e").alias("elsewhere"), _ranges("b").alias("earlier")))


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   keep: str = "none", max_variants: int = MAX_VARIANTS) -> DataFrame:
    """``(doc, spans)``: byte spans to remove (unmerged [start, end) pairs) by ``document_key``, where there are any."""
    if keep not in ("none", "first"):
        raise ValueError("keep is none or first")
    own = docs.select(document_key(id_col, text_col).alias("doc"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    count = T.StructType([T.StructField("key", T.LongType()), T.StructField("n", T.LongType())])
    # Sides that are joined on a key lie in files, so a hot key's partition can be split.
    keys = stored(own.mapInArrow(_scan(length, output_type(count), True), count)
                  .groupBy("key").agg(F.sum("n").alias("n")).where("n > 1").select("key"))
    found = own.mapInArrow(_scan(length, output_type(_WINDOW), False), _WINDOW)
    members = stored(found.join(keys, "key", "left_semi"))
    variants = stored(members.groupBy("key", "window").agg(
        F.count("*").alias("copies"), F.min(F.struct("doc", "start")).alias("first"), F.min("n").alias("n"))
        .select("key", "window", "first.doc", "first.start", "n", "copies"))
    several = stored(variants.groupBy("key").agg(F.count("*").alias("variants")).where("variants > 1"))
    many = variants.join(several.select("key"), "key")
    wanted = many.groupBy("doc").agg(F.collect_list(F.struct("key", "window", "doc", "start", "n", "copies")).alias("w"))
    raw = own.join(wanted, "doc").dropDuplicates(["doc"]).select("text", "w").mapInArrow(
        _cut(length, output_type(_VARIANT)), _VARIANT)
    large = several.where(F.col("variants") > max_variants).select("key")
    small = several.where(F.col("variants") <= max_variants).select("key")
    parts = [raw.join(small, "key", "left_semi").repartition("key").sortWithinPartitions("key")
             .mapInArrow(_order(length, output_type(_RESULT)), _RESULT)]
    if not large.isEmpty():
        parts.append(_split_keys(raw.join(large, "key", "left_semi"), length))
    solved = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    # Strings found in variants' first places; and all strings of members that are copies (of another place).
    # Each is one join, so the partitions of a very common window can be split.
    found_in = "elsewhere" if keep == "none" else "earlier"
    own_places = variants.where("copies = 1") if keep == "none" else variants
    firsts = (own_places.join(solved.select("key", "window", F.explode(found_in).alias("r")), ["key", "window"])
              .select("doc", F.struct((F.col("start") + F.col("r")[0]).alias("a"),
                                      (F.col("start") + F.col("r")[1] + (length - 1)).alias("b")).alias("s")))
    common = variants.where("copies > 1").select("key", "window", F.col("doc").alias("d"), F.col("start").alias("at"))
    copies = members.join(common, ["key", "window"])
    if keep == "first":
        copies = copies.where((F.col("doc") != F.col("d")) | (F.col("start") != F.col("at")))
    copies = copies.select("doc", F.struct(F.col("start").alias("a"),
                                           (F.col("start") + F.col("n") + (length - 1)).alias("b")).alias("s"))
    return firsts.unionByName(copies).groupBy("doc").agg(F.collect_list("s").alias("spans"))


def document_key(id_col: str, text_col: str):
    """What tells rows apart here: a hash of id and text (64 bits)."""
    return F.xxhash64(F.col(id_col).cast("string"), F.col(text_col).cast("string"))


def merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s in sorted((x["a"], x["b"]) for x in spans or ()):
        if out and s[0] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], s[1])
        else:
            out.append(list(s))
    return [(a, b) for a, b in out]


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   keep: str = "none", max_variants: int = MAX_VARIANTS, keep_bytes: bool = False) -> DataFrame:
    """One row per document: id, n_bytes, n_removed, n_spans, kept_sha256, and ``kept`` (bytes) if asked for."""
    spans = repeated_spans(docs, id_col, text_col, length, keep, max_variants)
    fields = [T.StructField(id_col, docs.schema[id_col].dataType),
              *[T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")],
              T.StructField("kept_sha256", T.StringType()), *([T.StructField("kept", T.BinaryType())] if keep_bytes else [])]
    schema = T.StructType(fields)
    out = output_type(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, text, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                      batch.column(2).to_pylist(), strict=True):
                raw, cut = (text or "").encode(), merged(own)
                edge = [0, *[x for s in cut for x in s], len(raw)]
                kept = b"".join([raw[a:b] for a, b in zip(edge[0::2], edge[1::2], strict=True)])
                rows.append((key, len(raw), len(raw) - len(kept), len(cut), hashlib.sha256(kept).hexdigest(),
                             *([kept] if keep_bytes else [])))
            if rows:
                yield record_batch(out, *map(list, zip(*rows, strict=True)))

    own = docs.select(document_key(id_col, text_col).alias("doc"), F.col(id_col).alias("id"),
                      F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return own.join(spans, "doc", "left").select("id", "text", "spans").mapInArrow(run, schema)
