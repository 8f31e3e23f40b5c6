"""Global order statistics without a single-partition window.

``row_number() over (order by k)`` with no ``partition by`` moves every row
into one task. The helpers here cut the order into *blocks* first:

* a block id that is monotone in the order (a hash prefix for seeded
  orders, the range partition for data-driven orders);
* a window *within* each block (one shuffle on the block id, each task
  holds about ``rows / blocks`` rows);
* per-block totals -> a prefix sum over the small ``(group, block)`` table
  -> broadcast back as offsets. That table has at most
  ``groups x blocks`` rows, a bound fixed by the parameters, not the data.

The result equals the single-partition window exactly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabspark.functions.columns import seeded_hash

# Number of order blocks for seeded hash orders: 16^4 prefixes of the md5
# hex. The offsets table has at most this many rows per group.
HASH_BLOCK_HEX_DIGITS = 4
# Data-driven orders (scores, values): range partitions of about ROWS_PER_BLOCK rows.
ROWS_PER_BLOCK = 1_000_000
MIN_BLOCKS = 8


def _cols(cs: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def _small(df: DataFrame, bounded: bool) -> DataFrame:
    """Broadcast hint only for a side whose size is a parameter; otherwise
    AQE decides from the runtime size (broadcast or sort-merge)."""
    return F.broadcast(df) if bounded else df


def blocked_running_sum(df: DataFrame, order: Sequence[str | Column], sums: Sequence[str],
                        block: str, groups: Sequence[str] = (), prefix: str = "cum_",
                        groups_bounded: bool = False) -> DataFrame:
    """Add ``<prefix><s>`` = running sum of ``s`` over ``order`` within ``groups``.

    ``block`` must be a column of ``df`` that is non-decreasing along
    ``order`` inside each group. Frame: rows from the start to the current
    row, like ``sum(s) over (partition by groups order by order rows
    between unbounded preceding and current row)``; ``order`` should be a
    total order so the running value of tied rows is defined.
    ``groups_bounded`` declares the group count a parameter (features,
    splits, epochs): only then is the ``groups x blocks`` offsets table
    hinted for broadcast; otherwise AQE picks the join from its runtime size.
    """
    groups = list(groups)
    within = (Window.partitionBy(*groups, block).orderBy(*_cols(order))
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = df.select("*", *[F.sum(s).over(within).alias(f"_loc_{s}") for s in sums])

    # Per-block totals: a partial aggregate over the input. Column pruning
    # narrows this branch's scan to the order/group/sum columns only.
    totals = df.groupBy(*groups, block).agg(*[F.sum(s).alias(f"_tot_{s}") for s in sums])
    before = (Window.partitionBy(*groups).orderBy(block)
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select(
        *groups, block,
        *[F.coalesce(F.sum(f"_tot_{s}").over(before), F.lit(0)).alias(f"_off_{s}") for s in sums])
    # One row per (group, block): bounded when the groups are.
    joined = local.join(_small(offsets, not groups or groups_bounded), on=[*groups, block], how="inner")
    return joined.select(
        *[F.col(c) for c in df.columns],
        *[(F.col(f"_off_{s}") + F.col(f"_loc_{s}")).alias(f"{prefix}{s}") for s in sums])


def hash_block(h: str | Column, digits: int = HASH_BLOCK_HEX_DIGITS) -> Column:
    """Block id from the leading hex digits of an md5 hex string."""
    h = F.col(h) if isinstance(h, str) else h
    return F.conv(F.substring(h, 1, digits), 16, 10).cast("int")


def row_number_by_hash(df: DataFrame, h: str, tiebreak: Sequence[str], out: str = "rank",
                       digits: int = HASH_BLOCK_HEX_DIGITS, groups: Sequence[str] = (),
                       groups_bounded: bool = False) -> DataFrame:
    """Global 1-based ``row_number() over ([partition by groups] order by h, *tiebreak)``.

    ``h`` is an md5 hex column: uniform, so its leading digits split the
    order into balanced blocks without sampling.
    """
    blk = "_blk"
    framed = df.withColumn(blk, hash_block(h, digits)).withColumn("_one", F.lit(1))
    ranked = blocked_running_sum(framed, [h, *tiebreak], ["_one"], blk, groups=groups, prefix="_rn",
                                 groups_bounded=groups_bounded)
    return ranked.withColumn(out, F.col("_rn_one").cast("bigint")).drop(blk, "_one", "_rn_one")


def seeded_rank(df: DataFrame, key: str, seed: int, out: str = "rank") -> DataFrame:
    """Rank of each row in the seeded random permutation (B1).

    Order: ``md5('<seed>-<key>')`` then ``key``; the same order DuckDB gives
    for ``order by md5(...), key``. ``key`` must be unique (every table here
    carries an explicit row key): with duplicates the order of tied rows,
    and so their ranks, would not be defined.
    """
    with_h = df.withColumn("_h", seeded_hash(seed, key))
    return row_number_by_hash(with_h, "_h", [key], out=out).drop("_h")


def blocks_for(rows: int) -> int:
    """Block count for a data-driven order over ``rows`` rows."""
    return max(MIN_BLOCKS, -(-rows // ROWS_PER_BLOCK))


def value_blocks(df: DataFrame, value: str, groups: Sequence[str] = (),
                 blocks: int | None = None, descending: bool = False, out: str = "_blk") -> DataFrame:
    """Attach a block id monotone in ``(groups, value)``: the range partition of each row.

    Spark's range exchange cuts the order at sampled bounds (a bounded
    sample per partition), so no task merges anything per group. The
    result is materialized: the block ids are read by several branches and
    must not be drawn twice. Rows should be pre-aggregated to distinct
    values, so a hot value is one row and cannot overload a block.
    ``blocks=None`` sizes the blocks from the row count.
    """
    from tabspark.session import materialize

    n = blocks if blocks is not None else blocks_for(df.count())
    pid = F.spark_partition_id()
    ranged = df.repartitionByRange(n, *groups, value)
    return materialize(ranged.withColumn(out, (F.lit(n - 1) - pid if descending else pid).cast("int")))


def running_sum_by_value(df: DataFrame, value: str, sums: Sequence[str], groups: Sequence[str] = (),
                         descending: bool = False, blocks: int | None = None,
                         prefix: str = "cum_", groups_bounded: bool = False) -> DataFrame:
    """Running sums of ``sums`` along ``value`` (asc or desc) within groups.

    ``value`` must be unique within a group (pre-aggregate first).
    """
    blocked = value_blocks(df, value, groups, blocks=blocks, descending=descending)
    order = [F.col(value).desc()] if descending else [F.col(value).asc()]
    return blocked_running_sum(blocked, order, sums, "_blk", groups, prefix=prefix,
                               groups_bounded=groups_bounded).drop("_blk")
