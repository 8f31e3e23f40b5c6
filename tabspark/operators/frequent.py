"""The k most frequent values, exact, in bounded memory.

A plain count shuffles every distinct value. Here the first pass merges a
frequent-items sketch (a bounded map per task), which gives candidates and,
for every value outside of them, a bound on its count: the sketch's error,
and the smallest estimate it lists (its estimates are never too small). The
second pass counts the candidates alone. If the k-th exact count exceeds the
bound, no other value can be among the first k; otherwise sketch and
candidates are widened, and beyond the sketch's largest size all values are
counted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabspark.operators.joins import bounded_broadcast

#: Values that a first sketch tracks and at most may track. Its error is at most 3.5 / tracked of all rows, and a value that
#: it doesn't list may have twice that.
TRACKED, MOST_TRACKED = 1 << 14, 1 << 19
ERROR_FACTOR = 7.0


def top_counts(df: DataFrame, col: str, k: int, tracked: int = TRACKED, most: int = MOST_TRACKED) -> tuple[DataFrame, int]:
    """(``value, n`` of the k most frequent non-null values, ties by the smaller value; the size of the sketch, 0: all were counted).

    ``df`` is read twice: give a table, or a stream of one that is cheap to make again.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    own = df.select(F.col(col).alias("value")).where(F.col(col).isNotNull())
    while tracked <= most and 4 * k <= tracked:
        wanted = min(8 * k, tracked)
        row = own.agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(value, {wanted}, {tracked})").alias("top")).first()
        listed = [(t["item"], t["count"]) for t in row["top"] or []]
        if not row["n"]:
            return _counted(own, k), tracked
        if not listed:
            tracked *= 8
            continue
        # Fewer values listed than asked for: the others' counts are bounded by the sketch's error alone.
        bound = max(ERROR_FACTOR * row["n"] / tracked, listed[-1][1] if len(listed) == wanted else 0)
        candidates = df.sparkSession.createDataFrame([(v,) for v, _ in listed], own.schema)  # at most 8k rows
        exact = _counted(own.join(bounded_broadcast(candidates, wanted), "value", "left_semi"), k)
        rows = exact.collect()  # k rows
        complete = len(listed) < wanted and row["n"] <= tracked / ERROR_FACTOR  # then the sketch has every value
        if complete or (len(rows) == k and rows[-1]["n"] > bound):
            return df.sparkSession.createDataFrame(rows, exact.schema), tracked
        tracked *= 8
    return _counted(own, k), 0


def _counted(own: DataFrame, k: int) -> DataFrame:
    return own.groupBy("value").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "value").limit(k)
