"""Row order, splits and sampling.

Spark rows have no position, so "the first n rows of a random
permutation" is defined by a seeded hash order ``md5('<seed>-<id>'), id``
that both Spark and SQL can evaluate. Two plans give the same rows:

* a *candidate prefix*: the order key is a uniform hash, so the rows whose
  60-bit hash prefix lies below a threshold are exactly the first rows of
  the order. One key-only aggregate counts the rows below every
  power-of-two threshold; the smallest one holding ``n`` rows keeps at most
  about ``2n`` candidates, and a top-n heap over them finishes. The single
  merge task sees about ``n`` rows, not ``partitions x n``; two passes;
* for ``n > TOP_N_LIMIT``: a distributed global rank
  (``ordering.seeded_rank``) and a filter, so no task ever holds more
  than one order block.

The fraction split (B6) needs neither: one narrow pass, disjoint by
construction.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabspark.functions.columns import attach_row, hex8_unit, seeded_hash, seeded_key
from tabspark.operators.ordering import seeded_rank, value_blocks

# Largest n served by a top-n heap; beyond it the distributed rank is used.
TOP_N_LIMIT = 200_000
# The reference's split sizes and seed-free defaults.
TRAIN_ROWS = 12000
VALID_ROWS = 5000
DEFAULT_SEED = 42


def permute(df: DataFrame, key: str = "id", seed: int = DEFAULT_SEED, out: str = "rank") -> DataFrame:
    """B1: every row with its 1-based position in the seeded permutation
    (``key`` unique)."""
    return seeded_rank(df, key, seed, out)


def _order(key: str, seed: int, descending: bool) -> list[Column]:
    h = seeded_hash(seed, key)
    if descending:
        return [h.desc(), F.col(key).desc()]
    return [h.asc(), F.col(key).asc()]


def _prefix60(key: str, seed: int) -> Column:
    return F.conv(F.substring(seeded_hash(seed, key), 1, 15), 16, 10).cast("bigint")


def _candidates(df: DataFrame, n: int, key: str, seed: int, from_top: bool) -> DataFrame | None:
    """Rows forming an exact prefix (or suffix) of the seeded order with at
    least ``n`` and about ``2n`` rows at most.

    One key-only aggregate counts, exactly, the rows below every
    power-of-two threshold ``2^k`` of the 60-bit hash prefix (61
    conditional sums, code-generated); the smallest threshold holding at
    least ``n`` rows is the cut. The count is exact, so no second check.
    """
    h = _prefix60(key, seed)
    top = 1 << 60
    if from_top:
        conds = [h >= F.lit(top - (1 << k)) for k in range(61)]
    else:
        conds = [h < F.lit(1 << k) for k in range(61)]
    row = df.select(key).agg(*[F.sum(F.when(c, 1).otherwise(0)).alias(f"k{k}") for k, c in enumerate(conds)]).first()
    counts = [row[f"k{k}"] or 0 for k in range(61)]
    if counts[60] <= n:
        return df
    k = next(k for k in range(61) if counts[k] >= n)
    return df.where(conds[k])


def head(df: DataFrame, n: int, key: str = "id", seed: int = DEFAULT_SEED) -> DataFrame:
    """B2: first ``n`` rows of the permutation (training set)."""
    if n <= TOP_N_LIMIT:
        cand = _candidates(df, n, key, seed, from_top=False)
        if cand is not None:
            return cand.orderBy(*_order(key, seed, False)).limit(n)
    return permute(df, key, seed, "_rank").where(F.col("_rank") <= n).drop("_rank")


def tail(df: DataFrame, n: int, key: str = "id", seed: int = DEFAULT_SEED) -> DataFrame:
    """Last ``n`` rows of the permutation (validation set)."""
    if n <= TOP_N_LIMIT:
        cand = _candidates(df, n, key, seed, from_top=True)
        if cand is not None:
            return cand.orderBy(*_order(key, seed, True)).limit(n)
    ranked = permute(df, key, seed, "_rank")
    total = ranked.agg(F.max("_rank").alias("_n"))
    return (attach_row(ranked, total)
            .where(F.col("_rank") > F.col("_n") - n).drop("_rank", "_n"))


def head_tail_split(df: DataFrame, n_train: int, n_valid: int, key: str = "id", seed: int = DEFAULT_SEED,
                    allow_overlap: bool = False, out: str = "split") -> DataFrame:
    """B2+B3 together: first ``n_train`` rows of the permutation are
    ``train``, last ``n_valid`` are ``valid``; others are dropped.

    On a table with fewer than ``n_train + n_valid`` rows the two ends
    overlap (the reference's 12000 + 5000 only fit 17000 rows exactly);
    that raises unless ``allow_overlap``, in which case shared rows are
    returned once per split. One key-only count checks the sizes; the
    labels come from the blocked rank, so any sizes work at scale.
    """
    total = df.select(key).count()
    if n_train + n_valid > total and not allow_overlap:
        raise ValueError(f"train {n_train} + valid {n_valid} > {total} rows: the splits would overlap; "
                         "use fraction_split or allow_overlap=True")
    ranked = permute(df, key, seed, "_rank")
    # No, one or two labels per row, from one ranked table.
    labels = F.array_compact(F.array(F.when(F.col("_rank") <= n_train, F.lit("train")),
                                     F.when(F.col("_rank") > total - n_valid, F.lit("valid"))))
    return ranked.withColumn(out, F.explode(labels)).drop("_rank")


def slice_rows(df: DataFrame, start: int, stop: int, key: str = "id",
               seed: int = DEFAULT_SEED, out: str = "rank") -> DataFrame:
    """Rows ``[start, stop)`` (0-based) of the permutation, with their rank."""
    ranked = permute(df, key, seed, out)
    return ranked.where((F.col(out) > start) & (F.col(out) <= stop))


def prefix(df: DataFrame, n: int, key: str = "id") -> DataFrame:
    """The ``n`` smallest keys (a cap to a prefix, or a peek).

    Keys are unique. The keys alone are cut into range blocks; their counts
    (one row per block) tell which block holds the n-th key, that block is
    ordered to find it, and the rows up to it are kept: exact for any n, and
    no task holds more than one block.
    """
    if n <= 0:
        return df.limit(0)
    keys = value_blocks(df.select(key), key)
    before = 0
    for r in keys.groupBy("_blk").agg(F.count(F.lit(1)).alias("c")).orderBy("_blk").collect():
        if before + r["c"] >= n:
            block = keys.where(F.col("_blk") == r["_blk"]).orderBy(F.col(key).asc_nulls_first()).limit(n - before)
            return df.where(F.col(key) <= F.lit(block.agg(F.max(key)).first()[0]))
        before += r["c"]
    return df


def fraction_split(df: DataFrame, fractions: dict[str, float], key: str = "id",
                   seed: int = DEFAULT_SEED, out: str = "split") -> DataFrame:
    """Label each row with a split name from a uniform hash draw.

    ``fractions`` are cumulative-ordered shares, e.g. ``{'train': 12/17,
    'valid': 5/17}``; the last split takes the remainder. No shuffle.
    """
    return df.withColumn(out, split_label(fractions, key, seed))


def split_label(fractions: dict[str, float], key: str = "id", seed: int = DEFAULT_SEED) -> Column:
    """The split name of a row, from the hash draw of its key."""
    u = hex8_unit(seeded_key(seed, key))
    names = list(fractions)
    expr = None
    acc = 0.0
    for name in names[:-1]:
        acc += fractions[name]
        cond = u < F.lit(acc)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    last = F.lit(names[-1])
    return last if expr is None else expr.otherwise(last)


def split_of(df: DataFrame, name: str, fractions: dict[str, float], key: str = "id",
             seed: int = DEFAULT_SEED) -> DataFrame:
    """Rows of one split (a filter on the hash draw, pushed below joins)."""
    return fraction_split(df, fractions, key, seed, "_split").where(F.col("_split") == name).drop("_split")


def sample_n(df: DataFrame, n: int, key: str = "id", seed: int = 7) -> DataFrame:
    """Exact-size uniform sample without replacement."""
    return head(df, n, key, seed)


# Fixed value: the reference's 12000 : 5000 train/validation proportion.
TRAIN_VALID = {"train": 12.0 / 17, "valid": 5.0 / 17}
# Three-way split used when a held-out test table is needed.
TRAIN_VALID_TEST = {"train": 0.6, "valid": 0.2, "test": 0.2}
