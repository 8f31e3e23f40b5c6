"""Documents as blocks of term counts: each term's string once a block, its occurrences as small integers.

A document-term table with a row per cell repeats the term's string (and the
document's key) in every cell, and a join of such a table moves all of them.
Here the documents of a task are dealt to blocks of about ``CELLS`` different
document-term pairs. A block is one row: the documents' keys, the terms that
occur in the block, and for each document the positions of its terms among
them, with counts, as packed integers. What concerns terms (numbers, vectors,
weights) is joined to a block's terms, not to its cells.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tabspark.session import materialize

#: Document-term pairs of a block, about; a document is never split.
CELLS = 4_000_000
#: Bytes of an Arrow batch that a task is handed at once, about.
BATCH_BYTES = 8 << 20


def bounded_batches(df: DataFrame) -> None:
    """Bound the bytes of Arrow batches, so that long texts don't fill a worker's memory."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def packed(values: np.ndarray) -> bytes:
    """Counts in the smallest unsigned type that holds them; ``unpacked`` tells it from the length."""
    return values.astype(np.min_scalar_type(int(values.max()) if len(values) else 0)).tobytes()


def unpacked(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, f"u{len(data) // n}" if n else "u1")


def _counted(terms: pa.ListArray) -> tuple[np.ndarray, pa.DictionaryArray, np.ndarray]:
    """Of a batch's term lists: different terms per row, these terms row by row, and their counts. Null terms are left out."""
    lengths = pc.fill_null(pc.list_value_length(terms), 0).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(terms), dtype=np.int64), lengths)
    flat = terms.flatten()
    if flat.null_count:
        row, flat = row[flat.is_valid().to_numpy(zero_copy_only=False)], flat.drop_null()
    encoded = flat.dictionary_encode()
    width = max(1, len(encoded.dictionary))
    cells, n = np.unique(row * width + encoded.indices.to_numpy(), return_counts=True)
    own = pa.DictionaryArray.from_arrays(pa.array((cells % width).astype(np.int32)), encoded.dictionary)
    return np.bincount(cells // width, minlength=len(terms)), own, n


def hashes(terms: pa.Array) -> np.ndarray:
    return pd.util.hash_array(terms.to_numpy(zero_copy_only=False).astype(object), categorize=False)


def hash_order(terms: pa.Array) -> np.ndarray:
    """The order by hash; terms of one hash by their strings, so that it is the same everywhere."""
    h = hashes(terms)
    order = np.argsort(h, kind="stable")
    if (h[order][1:] == h[order][:-1]).any():
        strings = terms.to_pylist()
        order = np.array(sorted(range(len(h)), key=lambda i: (h[i], strings[i])))
    return order


def _blocks(limit: int, schema: pa.Schema):
    def block(no: int, parts: list) -> pa.RecordBatch:
        chunks = pa.chunked_array([p[1] for p in parts]).unify_dictionaries().chunks
        terms = chunks[0].dictionary.cast(pa.string())
        order = hash_order(terms)
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order), dtype=np.int32)
        ids = place[np.concatenate([c.indices.to_numpy() for c in chunks])] if len(terms) else np.empty(0, np.int32)
        lengths = np.concatenate([p[0] for p in parts]).astype(np.int32)
        columns = [pa.array([v], f.type) for v, f in zip([no, ids.tobytes(), packed(np.concatenate([p[2] for p in parts]))], schema)]
        lists = [pa.array(lengths), terms.take(pa.array(order)), *(pa.concat_arrays([p[3][i] for p in parts]) for i in range(len(schema) - 5))]
        columns += [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v.cast(f.type.value_type))
                    for v, f in zip(lists, list(schema)[3:], strict=True)]
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        no, held, cells = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            lengths, own, n = _counted(batch.column(0))
            held.append((lengths, own, n, batch.columns[1:]))
            cells += len(own)
            if cells >= limit:
                yield block(no, held)
                no, held, cells = no + 1, [], 0
        if held:
            yield block(no, held)

    return run


def build(df: DataFrame, terms: str = "terms", keep: Sequence[str] = ("id",), cells: int = CELLS) -> DataFrame:
    """``(block, ids, counts, lengths, terms, <keep...>)``, written: a row per block of documents.

    ``keep``: columns whose values are kept as arrays, one entry per document.
    ``lengths``: different terms of each document; ``ids``: their positions in ``terms`` (int32), document by document;
    ``counts``: how often each occurs in it. Documents without terms are kept, null terms add nothing.
    """
    bounded_batches(df)
    own = df.select(F.col(terms).cast("array<string>"), *keep)
    kinds = {"block": T.LongType(), "ids": T.BinaryType(), "counts": T.BinaryType(), "lengths": T.ArrayType(T.IntegerType()),
             "terms": T.ArrayType(T.StringType())} | {c: T.ArrayType(own.schema[c].dataType) for c in keep}
    schema = T.StructType([T.StructField(c, kind) for c, kind in kinds.items()])
    # Few tasks, several blocks each: the more documents a block has, the less often a term's string is kept.
    few = own.coalesce(4 * df.sparkSession.sparkContext.defaultParallelism)
    return materialize(few.mapInArrow(_blocks(cells, to_arrow_schema(schema)), schema))


def documents(blocks: DataFrame, keep: Sequence[str] = ("id",)) -> DataFrame:
    """``(block, i, <keep...>)``: a row per document, ``i`` its place in the block."""
    rows = blocks.select("block", F.posexplode(F.arrays_zip(*keep)).alias("i", "_d"))
    return rows.select("block", "i", *[f"_d.{c}" for c in keep])


def _occurring(schema: pa.Schema):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, ids, lengths, use, terms in zip(*batch.columns, strict=True):
                ids = np.frombuffer(ids.as_py(), np.int32)
                cells = np.repeat(use.values.to_numpy(zero_copy_only=False), lengths.values.to_numpy())
                local = np.flatnonzero(np.bincount(ids[cells], minlength=len(terms.values)))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(local), block.as_py())), pa.array(local.astype(np.int32)),
                                                  terms.values.take(pa.array(local))], schema=schema)

    return run


def terms_in(blocks: DataFrame, use: Column | None = None) -> DataFrame:
    """``(block, local, term)``: a row per block and term that occurs in it, or in its documents of which the array ``use`` is true."""
    if use is None:
        return blocks.select("block", F.posexplode("terms").alias("local", "term"))
    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("local", T.IntegerType()), T.StructField("term", T.StringType())])
    return blocks.select("block", "ids", "lengths", use, "terms").mapInArrow(_occurring(to_arrow_schema(schema)), schema)
