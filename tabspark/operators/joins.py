"""Key joins (E1-E6) and the size-checked broadcast.

Rows are aligned by an explicit key, never by position: every
"index alignment" of the reference is an equi-join on ``id`` here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Largest side that is hinted for broadcast, in bytes.
BROADCAST_MAX_BYTES = 64 << 20


def row_bytes(df: DataFrame) -> int | None:
    """Bytes of a row whose columns all have a fixed width; None if one hasn't."""
    fixed = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType)
    return 16 * (1 + len(df.columns)) if all(isinstance(f.dataType, fixed) for f in df.schema.fields) else None


def bounded_broadcast(df: DataFrame, known_rows: int | None = None,
                      max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast hint only for a side proven to have at most ``max_bytes`` bytes.

    ``known_rows`` is a static bound (a top-k, a literal list, a grid): with
    columns of fixed width it settles the size. Otherwise the side's bytes
    are summed (meant for small inputs such as a vocabulary). Beyond the
    bound the join is left to the planner: sort-merge, or a broadcast AQE
    picks from runtime statistics.
    """
    width = row_bytes(df)
    if known_rows is not None and width is not None:
        size = known_rows * width
    else:
        size = df.agg(F.sum(F.length(F.to_json(F.struct("*"))) + 16)).first()[0] or 0
    return F.broadcast(df) if size <= max_bytes else df


def attach_target(features: DataFrame, targets: DataFrame, key: str = "id") -> DataFrame:
    """Features with their target by key; rows without one keep null."""
    return features.join(targets, key, "left")


def pair_by_key(left: DataFrame, right: DataFrame, key: str = "id") -> DataFrame:
    """Prediction beside target (inner join on the key, not position)."""
    return left.join(right, key, "inner")


def gather_by_key(df: DataFrame, keys: DataFrame, order_by, n_keys: int, key: str = "id") -> DataFrame:
    """Rows for a bounded key list, numbered in the list's order.

    ``n_keys`` bounds the key list (a sample size), so it is broadcast and
    its ordinal window runs over at most ``n_keys`` rows.
    """
    w = Window.orderBy(*order_by)
    numbered = keys.select(key, F.row_number().over(w).cast("bigint").alias("ordinal"))
    return bounded_broadcast(numbered, known_rows=n_keys).join(df, key)
