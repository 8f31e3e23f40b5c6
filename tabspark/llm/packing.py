"""Hierarchical packing of documents into sequences of several context sizes.

Every task tokenises its documents as they stream in and packs them in step
groups of about ``group_tokens`` tokens, so one scan does everything: no
shuffle, no row leaves its task, memory is bounded by a group.

In a step group documents are routed to the smallest tier (a power of two up
to ``max_len``) that holds them; longer ones are first cut into full windows.
Tiers are packed from the longest window down: a window takes its document,
its gap is filled with the largest shorter documents that fit whole, the
last bit with the front of the next one, whose rest is routed anew. What
remains at the end of a group is cut into descending powers of two, so no
sequence needs padding. The sequences of a group are dealt to steps of
nearly equal token counts, the largest first to the step with the fewest.

Defined cases
* null and empty texts have the end token alone, so one piece of length 1.
* null or repeated ids: every input row is a document of its own; ties keep input order.
* an empty table gives no pieces; a text of any length is cut, never dropped.
* columns of the input besides id and text are dropped.
* a special token's string inside a text gets that token's id, as the tokenizer itself gives it.
* the result depends on how the input is dealt to tasks, but not on retries.
"""

from __future__ import annotations

import heapq
import os
import zlib
from bisect import bisect_right, insort
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabspark.llm.tasks import output_type
from tabspark.llm.text import utf8

#: Distinct words that are encoded as one string.
JOINED = 256
#: Marks that are tokens apart from a letter before them (none of a special token's).
_MARKS = np.zeros(256, bool)
_MARKS[list(b".,;:!?%&*#$()")] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_PLAIN = np.zeros(256, bool)  # bytes of characters that are surely no white space
_PLAIN[0x21:0x7F] = True
_OTHER_WHITE = "[\u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
_ENCODERS: dict[str, "Encoder"] = {}


def cuts(data: np.ndarray, offsets: np.ndarray, other_white: np.ndarray) -> np.ndarray:
    """Places where rows of UTF-8 may be cut so that the parts' token ids are the whole's; rows' ends are among them.

    The vocabulary's splitting pattern never crosses from other characters
    into white space, so a cut may stand before a run of white space; after a
    line break that is a run by itself; and between a letter and a mark.
    ``other_white`` marks the rows that hold white space beyond ASCII's.
    """
    if not len(data):
        return np.unique(offsets)
    plain = _PLAIN[data]
    if (data >= 128).any():
        plain |= (data >= 128) & np.repeat(~other_white, np.diff(offsets))
    cut = np.zeros(len(data) + 1, bool)
    cut[1:-1] = (_WHITE[data[1:]] & plain[:-1]) | (_MARKS[data[1:]] & _LETTER[data[:-1]])
    alone = np.flatnonzero((data[1:-1] == 10) & plain[:-2] & plain[2:]) + 2
    cut[alone] = True
    cut[offsets] = True
    return np.flatnonzero(cut)


class Encoder:
    """Token ids of texts; a batch's distinct words are encoded once."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the threads
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # In a byte-level vocabulary a token has one character for each of its bytes.
        vocabulary = self.tokenizer.get_vocab()
        self.n_bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.n_bytes[i] = len(token)

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows, offsets of each row's). Null is empty."""
        data, offsets = utf8(texts)
        white = pc.fill_null(pc.match_substring_regex(texts, _OTHER_WHITE), False).to_numpy(zero_copy_only=False)
        at = cuts(data, offsets, white)
        if len(at) < 2:
            return np.zeros(0, "<u4"), np.zeros(len(offsets), np.int64)
        parts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at) - 1,
                                                 [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(data)])
        coded = parts.dictionary_encode()
        flat, begin, size = self._words(coded.dictionary, not white.any())
        word = coded.indices.to_numpy()
        n = size[word]
        ends = np.cumsum(n)
        out = flat[np.repeat(begin[word] - (ends - n), n) + np.arange(ends[-1])]
        return out, np.concatenate([[0], ends])[np.searchsorted(at, offsets)]

    def encode(self, texts: Sequence[str | None]) -> list[bytes]:
        """Each text's ids as little-endian 32-bit bytes."""
        ids, offsets = self.encode_column(pa.array(texts, pa.string()))
        return [ids[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]

    def _words(self, words: pa.Array, ascii_white: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, begin, size) of each word.

        Words that begin with one space and end in no white space are encoded
        many at a time and told apart by their bytes, the others one by one.
        """
        data, offsets = utf8(words)
        first, last = data[offsets[:-1]], data[offsets[1:] - 1]
        second = data[np.minimum(offsets[:-1] + 1, len(data) - 1)]
        long = np.diff(offsets) > 1
        solid = _PLAIN | (np.arange(256) >= 128) if ascii_white else _PLAIN
        joined = (first == 32) & long & solid[second] & solid[last]
        order = np.concatenate([np.flatnonzero(joined), np.flatnonzero(~joined)])
        n = int(joined.sum())
        raw, ends = utf8(words.take(pa.array(order)))
        edge = np.unique(np.concatenate([np.arange(0, n, JOINED), np.arange(n, len(order) + 1)]))
        whole = raw.tobytes()
        texts = [whole[a:b].decode() for a, b in zip(ends[edge[:-1]].tolist(), ends[edge[1:]].tolist(), strict=True)]
        ids = [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        flat = np.concatenate(ids)
        # A word's tokens end where the bytes of the tokens so far reach the word's end.
        size = np.diff(np.searchsorted(np.cumsum(self.n_bytes[flat]), ends[1:]) + 1, prepend=0)
        begin, count = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
        begin[order], count[order] = np.cumsum(size) - size, size
        return flat, begin, count


def encoder(path: str) -> Encoder:
    """One encoder per worker process and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def tiers(max_len: int, smallest: int = 256) -> list[int]:
    """Context sizes, longest first: powers of two from max_len down to smallest."""
    out = [max_len]
    while out[-1] > smallest:
        out.append(out[-1] // 2)
    return out


def pack_group(lengths: Sequence[int], max_len: int, smallest: int = 256) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """Sequences of one step group: (context size, pieces (document, start, length) in order).

    Every sequence is full; every token of every document is in one piece.
    """
    sizes = tiers(max_len, smallest)
    out: list[tuple[int, list[tuple[int, int, int]]]] = []
    pool: list[tuple[int, int, int]] = []  # (length, document, start), shortest first
    for doc, n in enumerate(lengths):
        at = 0
        while n - at >= max_len:
            out.append((max_len, [(doc, at, max_len)]))
            at += max_len
        if n > at:
            pool.append((n - at, doc, at))
    pool.sort()
    total = sum(x[0] for x in pool)
    while pool:
        longest = pool[-1][0]
        size = min(s for s in sizes if s >= longest)
        if total < size:  # the rest of the group: descending powers of two
            size = 1 << (total.bit_length() - 1)
        gap, pieces = size, []
        while gap:
            i = bisect_right(pool, (gap, 1 << 62, 0)) - 1
            n, doc, at = pool.pop(i if i >= 0 else 0)
            take = min(n, gap)
            pieces.append((doc, at, take))
            if n > take:
                insort(pool, (n - take, doc, at + take))
            gap -= take
        out.append((size, pieces))
        total -= size
    return out


def step_of(sizes: Sequence[int], step_tokens: int) -> list[int]:
    """Step number of each sequence: the largest first, each to the step with the fewest tokens."""
    n = max(1, round(sum(sizes) / step_tokens))
    heap = [(0, s) for s in range(n)]
    out = [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        load, s = heapq.heappop(heap)
        out[i] = s
        heapq.heappush(heap, (load + sizes[i], s))
    return out


SCHEMA = T.StructType([
    T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("ids_crc32", T.LongType()), T.StructField("doc_tokens", T.LongType()),
    T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()),
    T.StructField("context", T.LongType()), T.StructField("step", T.LongType())])


def _packer(tokenizer_path: str, end_id: int, max_len: int, group_tokens: int,
            step_tokens: int, keep_ids: bool, schema: pa.Schema) -> Callable:
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path)
        sequence, step = [TaskContext.get().partitionId() << 36], [TaskContext.get().partitionId() << 36]
        ids: list = []
        held: list[bytes] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal size
            done = pack_group([len(b) // 4 for b in held], max_len)
            steps = step_of([s for s, _ in done], step_tokens)
            rows: list[tuple] = []
            for (context, pieces), own in zip(done, steps, strict=True):
                offset = 0
                for doc, at, n in pieces:
                    own_ids = held[doc][4 * at:4 * (at + n)]
                    rows.append((ids[doc], at, n, zlib.crc32(own_ids), len(held[doc]) // 4, sequence[0], offset,
                                 context, step[0] + own, *([own_ids] if keep_ids else [])))
                    offset += n
                sequence[0] += 1
            step[0] += max(steps, default=-1) + 1
            ids.clear()
            held.clear()
            size = 0
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

        for batch in batches:
            keys, (tokens, edges) = batch.column(0).to_pylist(), enc.encode_column(batch.column(1))
            tokens = tokens.tobytes()
            for key, a, b in zip(keys, (4 * edges[:-1]).tolist(), (4 * edges[1:]).tolist(), strict=True):
                ids.append(key)
                held.append(tokens[a:b] + end)
                size += (b - a) // 4 + 1
                if size >= group_tokens:
                    yield flush()
        if held:
            yield flush()

    return run


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1,
         max_len: int = 2048, group_tokens: int = 1 << 20, step_tokens: int = 1 << 16,
         keep_ids: bool = False) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset, context, step.

    ``keep_ids`` adds ``ids``, the piece's token ids as little-endian 32-bit
    bytes. ``max_len`` must be a power of two.
    """
    if max_len & (max_len - 1):
        raise ValueError("max_len must be a power of two")
    fields = [T.StructField(id_col, docs.schema[id_col].dataType), *SCHEMA.fields]
    if keep_ids:
        fields.append(T.StructField("ids", T.BinaryType()))
    schema = T.StructType(fields)
    own = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    return own.mapInArrow(_packer(tokenizer_path, end_id, max_len, group_tokens, step_tokens, keep_ids,
                                  output_type(schema)), schema)
