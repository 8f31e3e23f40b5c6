"""Row-wise column expressions.

Everything here is ``Column -> Column`` built from ``pyspark.sql.functions``,
so it compiles into whole-stage codegen and never leaves the JVM. Nulls go
in -> null comes out; a zero denominator gives null (Spark's ANSI ``/``
would throw). The same arithmetic is written in the DuckDB oracles, so
results are bit-equal wherever only ``+ - * /`` are involved.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Fixed value: log loss clips probabilities to [EPS, 1 - EPS].
LOG_LOSS_EPS = 1e-15
# Fixed value: 2^32, the range of an 8-hex-digit md5 prefix.
TWO_POW_32 = 4294967296.0


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round6(c: ColumnOrName) -> Column:
    """Round half away from zero to 6 decimals as ``round(x*1e6)/1e6``.

    Written this way (not ``round(x, 6)``) so Spark and DuckDB agree bit for
    bit; used only where the last bits legitimately differ (sums of doubles
    in another order, ``exp``/``ln``).
    """
    return F.round(_c(c) * 1e6) / 1e6


def safe_ratio(a: ColumnOrName, b: ColumnOrName) -> Column:
    """``a / b``; null when ``b`` is 0 or either side is null."""
    return F.try_divide(_c(a).cast("double"), _c(b).cast("double"))


def cap_upper(x: ColumnOrName, cap: float) -> Column:
    """``min(x, cap)`` keeping nulls null."""
    x = _c(x)
    return F.when(x.isNull(), F.lit(None)).otherwise(F.least(x, F.lit(float(cap))))


def clip(x: ColumnOrName, lo: float, hi: float) -> Column:
    """``max(min(x, hi), lo)`` keeping nulls null."""
    x = _c(x)
    return F.when(x.isNull(), F.lit(None)).otherwise(
        F.greatest(F.least(x, F.lit(float(hi))), F.lit(float(lo))))


def log_normalize(x: ColumnOrName) -> Column:
    """``ln(x + 1)`` (C11); not ``log1p`` so both engines agree."""
    return F.ln(_c(x) + F.lit(1.0))


def binary_threshold(x: ColumnOrName, t: float) -> Column:
    """1 if ``x > t`` else 0 (C13); null stays null."""
    x = _c(x)
    return F.when(x.isNull(), F.lit(None)).when(x > F.lit(float(t)), F.lit(1)).otherwise(F.lit(0))


def as_flag(pred: Column) -> Column:
    """Boolean predicate -> 0.0 / 1.0 double (C4)."""
    return pred.cast("double")


def linear_scale_expr(x: ColumnOrName, lo: ColumnOrName, hi: ColumnOrName) -> Column:
    """``(x - lo) / ((hi - lo) / 2) - 1`` (C8); null for a constant column."""
    x, lo, hi = _c(x), _c(lo), _c(hi)
    return F.try_divide(x - lo, (hi - lo) / F.lit(2.0)) - F.lit(1.0)


def z_score_expr(x: ColumnOrName, mean: ColumnOrName, std: ColumnOrName) -> Column:
    """``(x - mean) / std`` (C12); null when ``std`` is 0."""
    return F.try_divide(_c(x) - _c(mean), _c(std))


def sigmoid(z: ColumnOrName) -> Column:
    """Logistic function ``1 / (1 + exp(-z))``."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_c(z)))


def hex8_unit(s: ColumnOrName) -> Column:
    """First 8 hex digits of ``md5(s)`` as a number in [0, 1).

    Same value in Spark and DuckDB; a uniform, seedable, per-row draw that
    needs no shuffle and no state.
    """
    return F.conv(F.substring(F.md5(_c(s).cast("string")), 1, 8), 16, 10).cast("bigint") / F.lit(TWO_POW_32)


def seeded_key(seed: int | str, key: ColumnOrName) -> Column:
    """The string ``'<seed>-<key>'`` hashed by the seeded order helpers."""
    return F.concat(F.lit(f"{seed}-"), _c(key).cast("string"))


def seeded_hash(seed: int | str, key: ColumnOrName) -> Column:
    """``md5('<seed>-<key>')`` hex: a reproducible random order key (B1)."""
    return F.md5(seeded_key(seed, key))


def md5_bucket(s: ColumnOrName, buckets: int) -> Column:
    """Hash a string into ``[0, buckets)`` via its md5 prefix."""
    h = F.conv(F.substring(F.md5(_c(s).cast("string")), 1, 8), 16, 10).cast("bigint")
    return F.pmod(h, F.lit(int(buckets))).cast("bigint")


def bucket_of(x: ColumnOrName, bounds: ColumnOrName | Sequence[float]) -> Column:
    """Bucket id = number of boundaries <= x (D3). Null x -> null.

    Tolerates duplicate and unsorted boundaries, unlike ``ml.Bucketizer``.
    """
    x = _c(x)
    if isinstance(bounds, (list, tuple)):
        b = F.array(*[F.lit(float(v)) for v in bounds])
    else:
        b = _c(bounds)
    return F.when(x.isNull(), F.lit(None)).otherwise(
        F.size(F.filter(b, lambda v: v <= x)).cast("bigint"))


def in_range(x: ColumnOrName, lo: float, hi: float) -> Column:
    """1.0 if ``lo <= x < hi`` else 0.0; null stays null."""
    x = _c(x)
    return F.when(x.isNull(), F.lit(None)).otherwise(
        ((x >= F.lit(float(lo))) & (x < F.lit(float(hi)))).cast("double"))


def one_hot(idx: ColumnOrName, k: int) -> Column:
    """Array of ``k`` 0/1 ints with a 1 at ``idx`` (D10); null idx -> null."""
    idx = _c(idx)
    return F.when(idx.isNull(), F.lit(None)).otherwise(
        F.transform(F.sequence(F.lit(0), F.lit(k - 1)),
                    lambda i: F.when(i == idx, F.lit(1)).otherwise(F.lit(0))))


def argmax(v: ColumnOrName) -> Column:
    """0-based position of the largest entry; first one wins on ties (H3)."""
    v = _c(v)
    return (F.array_position(v, F.array_max(v)) - F.lit(1)).cast("bigint")


def dot(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Dot product of two numeric arrays of equal length."""
    prod = F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(prod, F.lit(0.0), lambda acc, v: acc + v)


def linear_scores(v: str, weights: Sequence[Sequence[float]], bias: Sequence[float] | None = None) -> Column:
    """``weights . v`` for each row of weights, as an array: a sum of products in generated code.

    Given to Spark as one expression text: a column object per product would
    take longer to build than the scores to compute. A position beyond the
    vector's end makes the score null.
    """
    def text(x: float) -> str:
        return f"double('{float(x)!r}')"

    sums = []
    for k, ws in enumerate(weights):
        terms = ([text(bias[k])] if bias is not None else []) + [f"cast(get(`{v}`, {j}) as double) * {text(w)}" for j, w in enumerate(ws)]
        sums.append(" + ".join(terms))
    return F.expr(f"array({', '.join(sums)})")


def vector_scale(v: ColumnOrName, divisor: float) -> Column:
    """Element-wise ``v / divisor``."""
    return F.transform(_c(v), lambda x: x.cast("double") / F.lit(float(divisor)))


def pad_to(arr: ColumnOrName, width: ColumnOrName, fill: str = "") -> Column:
    """Right-pad an array of strings with ``fill`` up to ``width``."""
    arr = _c(arr)
    k = F.greatest(_c(width) - F.size(arr), F.lit(0))
    return F.concat(arr, F.array_repeat(F.lit(fill), k))


def terms_of(text: ColumnOrName) -> Column:
    """Lower-cased word and sentence-mark tokens of a text (A3)."""
    return F.regexp_extract_all(F.lower(_c(text)), F.lit(TERM_PATTERN), 0)


# Fixed value: the token pattern, words of letters or one of ? . !
TERM_PATTERN = r"\p{L}+|[?.!]"


def with_count_le(df, sorted_arr: str, x: ColumnOrName, length: int, out: str):
    """``df`` plus ``out`` = number of entries of ``sorted_arr`` that are ``<= x``.

    Equal to ``size(filter(arr, b -> b <= x))`` for an ascending array
    (duplicates allowed), at O(log length) per row. Null ``x`` -> null.
    """
    x = _c(x)
    step = 1
    while step * 2 <= length:
        step *= 2
    cur = f"{out}__p"
    df = df.withColumn(cur, F.lit(0))
    while step >= 1:
        nxt = F.col(cur) + F.lit(step)
        probe = F.try_element_at(F.col(sorted_arr), nxt)
        df = df.withColumn(cur, F.when((nxt <= F.lit(length)) & (probe <= x), nxt).otherwise(F.col(cur)))
        step //= 2
    return df.withColumn(out, F.when(x.isNull(), F.lit(None)).otherwise(F.col(cur).cast("bigint"))).drop(cur)


def attach_row(df, row_df, cols=None):
    """``df`` plus the columns of a one-row DataFrame (statistics, a fitted
    line, cut points), without a join.

    The whole row is ONE scalar subquery (a struct of the wanted columns):
    it runs once, its value reaches every task as a constant, the big side
    is not shuffled. The struct is unpacked by field access afterwards.
    """
    cols = list(cols) if cols is not None else list(row_df.columns)
    packed = row_df.select(F.struct(*[F.col(c) for c in cols]).alias("_row")).scalar()
    with_row = df.select("*", packed.alias("__row"))
    return with_row.select(*[F.col(c) for c in df.columns],
                           *[F.col("__row")[c].alias(c) for c in cols])
