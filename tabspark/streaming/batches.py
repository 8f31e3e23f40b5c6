"""Batching plans.

A training input pipeline "batch -> repeat -> shuffle" becomes a table
that says, for every epoch, in which batch and at which batch position
each row is consumed. Everything is keyed by ``id`` and seeded hashes, so
the plan is reproducible and needs no global single-partition window:
row and batch numbers come from ``ordering.row_number_by_hash``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabspark.functions.columns import pad_to, seeded_hash
from tabspark.operators.ordering import row_number_by_hash


# Epochs up to which the offsets (65,536 rows of 16 bytes for each) are hinted for broadcast.
MAX_EPOCHS = 32


def batch_assign(df: DataFrame, size: int, key: str = "id", seed: int = 42) -> DataFrame:
    """Consecutive rows of the seeded permutation grouped by ``size``.

    Adds ``rank`` (1-based) and ``batch_id`` = ``(rank - 1) div size``.
    """
    h = df.withColumn("_h", seeded_hash(seed, key))
    r = row_number_by_hash(h, "_h", [key], out="rank").drop("_h")
    return r.withColumn("batch_id", F.expr(f"(rank - 1) div {int(size)}"))


def _epochs(df: DataFrame, epochs: int) -> DataFrame:
    """Repeat every row ``epochs`` times (a generator, not a join)."""
    seq = F.sequence(F.lit(0).cast("bigint"), F.lit(int(epochs) - 1).cast("bigint"))
    return df.withColumn("epoch", F.explode(seq))


def epoch_plan(df: DataFrame, size: int, epochs: int, key: str = "id", seed: int = 42,
               mode: str = "batches") -> DataFrame:
    """``(epoch, batch_order, batch_id, id)``.

    ``mode='batches'``: batch membership fixed once, the batch order is
    reshuffled every epoch (shuffle after batching). ``mode='rows'``:
    rows are reshuffled every epoch before batching.
    """
    if mode == "batches":
        rows = batch_assign(df.select(key), size, key, seed)
        batches = _epochs(rows.select("batch_id").distinct(), epochs)
        bh = batches.withColumn(
            "_h", F.md5(F.concat_ws("-", F.lit(str(seed)), F.col("epoch").cast("string"),
                                    F.col("batch_id").cast("string"))))
        order = row_number_by_hash(bh, "_h", ["batch_id"], out="batch_order", groups=["epoch"],
                                   groups_bounded=epochs <= MAX_EPOCHS).drop("_h")
        return rows.join(order, "batch_id").select("epoch", "batch_order", "batch_id", key)
    if mode == "rows":
        rep = _epochs(df.select(key), epochs)
        rh = rep.withColumn(
            "_h", F.md5(F.concat_ws("-", F.lit(str(seed)), F.col("epoch").cast("string"), F.col(key).cast("string"))))
        r = row_number_by_hash(rh, "_h", [key], out="_rank", groups=["epoch"],
                               groups_bounded=epochs <= MAX_EPOCHS).drop("_h")
        r = r.withColumn("batch_id", F.expr(f"(_rank - 1) div {int(size)}"))
        return r.select("epoch", F.col("batch_id").alias("batch_order"), "batch_id", key)
    raise ValueError(f"mode must be 'batches' or 'rows', not {mode!r}")


def padded_batch(df: DataFrame, terms: str, size: int, key: str = "id", seed: int = 42,
                 fill: str = "") -> DataFrame:
    """Pad each term list to the longest list of its batch.

    The width is a window over one batch (``size`` rows at most).
    """
    b = batch_assign(df, size, key, seed)
    w = Window.partitionBy("batch_id")
    width = F.max(F.size(terms)).over(w)
    return b.select(key, "batch_id", width.cast("bigint").alias("width"),
                    pad_to(terms, width, fill).alias("padded"))
