"""Learned vectors for all terms of the training documents.

The terms' vectors are factors of the document-term table (Spark ML's ALS on
implicit counts): blocks of documents and of terms take turns, factors stay
tables, and no vocabulary, no coefficient per term and no factor ever comes
to the driver. A document's vector, of training rows or later ones, is the
mean of its known terms' vectors, and a classifier of ``rank`` inputs is fitted on
these: what the driver holds doesn't grow with the vocabulary.

Documents are held as blocks of counts (``term_blocks``): numbers and vectors are
joined to the terms of a block, not to its cells. ALS gets as many blocks as
keep one's cells within ``ALS_CELLS``, since a task holds a whole block.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.recommendation import ALS
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabspark.operators import term_blocks
from tabspark.operators.ordering import row_number_by_hash
from tabspark.session import materialize

#: Cells of the document-term table that one of ALS's blocks holds, about; its least number of blocks is Spark's default.
ALS_CELLS, ALS_BLOCKS = 4_000_000, 10
#: Rows of an Arrow batch that a task gives out.
OUT_ROWS = 1 << 16


def _means(rank: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lengths, ids, keys, hits in zip(*batch.columns, strict=True):
                lengths, ids, hits = lengths.values.to_numpy(), np.frombuffer(ids.as_py(), np.int32), hits.values
                local, vectors = hits.field(0).to_numpy(), hits.field(1).flatten().to_numpy().reshape(-1, rank)
                at = np.full(ids.max(initial=-1) + 1, -1, np.int32)
                at[local] = np.arange(len(local), dtype=np.int32)
                doc, of = np.repeat(np.arange(len(lengths)), lengths), at[ids]
                doc, of = doc[of >= 0], of[of >= 0]
                n = np.bincount(doc, minlength=len(lengths))
                some = np.flatnonzero(n)
                sums = [pa.array(np.bincount(doc, vectors[of, i].astype(np.float64), len(lengths))[some]) for i in range(rank)]
                yield pa.RecordBatch.from_arrays([keys.values.take(pa.array(some)), pa.array(n[some]), *sums],
                                                 ["_key", "_n", *[f"_v{i}" for i in range(rank)]])

    return run


@dataclass
class TermFactors:
    """``terms`` is ``(term, vector)``, a row per term of the training documents."""

    terms: DataFrame
    rank: int

    def _with_means(self, df: DataFrame, blocks: DataFrame, key: str) -> DataFrame:
        """``df`` with ``vector``, of the blocks' documents of the same key."""
        hits = term_blocks.terms_in(blocks).join(self.terms, "term").groupBy("block").agg(
            F.collect_list(F.struct("local", "vector")).alias("hits"))
        kind = blocks.schema[key].dataType.elementType.simpleString()
        cols = [f"_v{i}" for i in range(self.rank)]
        sums = blocks.join(hits, "block").select("lengths", "ids", key, "hits").mapInArrow(
            _means(self.rank), f"_key {kind}, _n long, " + ", ".join(f"{c} double" for c in cols))
        mean = sums.groupBy(F.col("_key").alias(key)).agg(*[(F.sum(c) / F.sum("_n")).alias(c) for c in cols])
        vector = F.array(*[F.coalesce(c, F.lit(0.0)) for c in cols])
        return df.join(mean, key, "left").withColumn("vector", vector).drop(*cols)

    def embed(self, df: DataFrame, terms: str = "terms", key: str = "id") -> DataFrame:
        """``df`` with ``vector``: the mean of the row's different known terms, zeros if there are none. ``key`` is unique."""
        return self._with_means(df, term_blocks.build(df, terms, [key]), key)

    def embed_blocks(self, blocks: DataFrame, key: str = "id", keep: tuple[str, ...] = ()) -> DataFrame:
        """The same for documents in blocks: ``(<key>, <keep...>, vector)``."""
        return self._with_means(term_blocks.documents(blocks, (key, *keep)).drop("block", "i"), blocks, key)


def numbered(values: DataFrame, col: str) -> DataFrame:
    """``(col, _no)``: the different values, numbered from 0 in the order of a hash, block by block."""
    # Written: the numbers need it twice, per block and in order.
    own = materialize(values.select(col).distinct().withColumn("_h", F.md5(F.col(col).cast("string"))))
    return row_number_by_hash(own, "_h", [col], out="_rank").select(col, (F.col("_rank") - 1).cast("int").alias("_no"))


def fit(train: DataFrame, rank: int = 8, iterations: int = 8, reg: float = 0.05, alpha: float = 10.0, terms: str = "terms",
        key: str = "id", seed: int = 42) -> TermFactors:
    """Factors of the training documents' terms. Rows without terms, and null terms, add nothing."""
    return fit_blocks(term_blocks.build(train, terms, [key]), rank, iterations, reg, alpha, key, seed)


_CODED = "rows binary, again binary, lengths binary, nos binary, counts binary"


def _coded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A block's documents and terms by their numbers; documents without a number are left out."""
    for batch in batches:
        for lengths, ids, counts, nos, rows in zip(*batch.columns, strict=True):
            lengths, ids, nos, rows = lengths.values.to_numpy(), np.frombuffer(ids.as_py(), np.int32), nos.values, rows.values
            no_of = np.full(ids.max(initial=-1) + 1, -1, np.int32)
            no_of[nos.field(0).to_numpy()] = nos.field(1).to_numpy()
            at = rows.field(0).to_numpy()
            used = np.zeros(len(lengths), bool)
            used[at] = True
            cells, order = np.repeat(used, lengths), np.argsort(at)
            values = [rows.field(1).to_numpy()[order], rows.field(2).to_numpy(zero_copy_only=False)[order], lengths[used], no_of[ids[cells]],
                      term_blocks.unpacked(counts.as_py(), len(ids))[cells]]
            yield pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in values],
                                             ["rows", "again", "lengths", "nos", "counts"])


def _cells(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, again, lengths, nos, counts in zip(*batch.columns, strict=True):
            lengths, nos = np.frombuffer(lengths.as_py(), np.int32), np.frombuffer(nos.as_py(), np.int32)
            rows, again = (np.repeat(np.frombuffer(v.as_py(), t), lengths) for v, t in ((rows, np.int32), (again, bool)))
            n = term_blocks.unpacked(counts.as_py(), len(nos)).astype(np.float32)
            for at in range(0, len(nos), OUT_ROWS):
                yield pa.RecordBatch.from_arrays([pa.array(v[at:at + OUT_ROWS]) for v in (rows, nos, n, again)], ["_row", "_no", "n", "_again"])


def _ratings(blocks: DataFrame, nos: DataFrame, doc_rows: DataFrame, repeated: bool) -> tuple[DataFrame, int]:
    """``(_row, _no, n)``, a row per document and term, and how many there are about."""
    terms_of = nos.groupBy("block").agg(F.collect_list(F.struct("local", "_no")).alias("nos"))
    docs_of = doc_rows.groupBy("block").agg(F.collect_list(F.struct("i", "_row", "_again")).alias("rows"))
    # Written in numbers: a fit asks an unwritten table for its partitions first, which runs the joins a second time.
    coded = materialize(blocks.join(terms_of, "block").join(docs_of, "block").select("lengths", "ids", "counts", "nos", "rows")
                        .mapInArrow(_coded, _CODED))
    every = coded.mapInArrow(_cells, "_row int, _no int, n float, _again boolean")
    rows = every.where("not _again").drop("_again") if repeated else every.drop("_again")
    if repeated:  # a document of several rows: its counts are added
        rows = rows.unionByName(every.where("_again").groupBy("_row", "_no").agg(F.sum("n").cast("float").alias("n")))
    return rows, coded.agg(F.coalesce(F.sum(F.octet_length("nos")), F.lit(0))).first()[0] // 4


def fit_blocks(blocks: DataFrame, rank: int = 8, iterations: int = 8, reg: float = 0.05, alpha: float = 10.0, key: str = "id",
               seed: int = 42, use: Column | None = None) -> TermFactors:
    """The same of documents in blocks; ``use``: an array of booleans that says which of a block's documents are for training."""
    used = F.transform("lengths", lambda n: n > 0)
    if use is not None:
        used = F.zip_with(used, use, lambda a, b: a & F.coalesce(b, F.lit(False)))
    docs = term_blocks.documents(blocks.withColumn("_used", used).withColumnRenamed(key, "_doc"), ("_doc", "_used")).where("_used")
    # Documents are numbered by a row each, terms by a row per block.
    doc_no = materialize(numbered(docs, "_doc").withColumnRenamed("_no", "_row"))
    local = materialize(term_blocks.terms_in(blocks, None if use is None else used.alias("use")))
    term_no = materialize(numbered(local, "term"))
    if term_no.isEmpty():
        return TermFactors(term_no.select("term", F.array().cast("array<float>").alias("vector")), rank)
    many = materialize(docs.groupBy("_doc").agg(F.count(F.lit(1)).alias("n")).where("n > 1 and _doc is not null")
                       .select("_doc", F.lit(True).alias("_again")))
    doc_rows = docs.join(doc_no, "_doc").join(many, "_doc", "left").select("block", "i", "_row", F.coalesce("_again", F.lit(False)).alias("_again"))
    rows, n = _ratings(blocks, local.join(term_no, "term"), doc_rows, not many.isEmpty())
    parts = max(ALS_BLOCKS, -(-n // ALS_CELLS))
    # With many blocks the factors that are sent each round are a multiple of the table: they are let go every second round.
    model = ALS(rank=rank, maxIter=iterations, regParam=reg, alpha=alpha, implicitPrefs=True, userCol="_row", itemCol="_no", ratingCol="n",
                seed=seed, numUserBlocks=parts, numItemBlocks=parts, checkpointInterval=2 if parts > ALS_BLOCKS else 10).fit(rows)
    factors = model.itemFactors.select(F.col("id").alias("_no"), F.col("features").alias("vector"))
    return TermFactors(materialize(term_no.join(factors, "_no").select("term", "vector")), rank)


def as_features(df: DataFrame, vector: str = "vector", out: str = "features") -> DataFrame:
    return df.withColumn(out, array_to_vector(F.col(vector)))
