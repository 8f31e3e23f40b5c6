"""Exact quantiles from mergeable sketches.

``percentile`` merges a value -> count map of all distinct values in one
task. Here no task holds more than a sketch, and no table of the distinct
values is written:

1. One pass counts each column's values and merges a KLL sketch per column
   (``sketches`` keeps one per part of the table, so new parts can be added
   without reading the old ones).
2. The sketch bounds the value range around each wanted rank. The next pass
   counts, exactly, the rows between the ranges, and sketches again inside
   them; ranges shrink by a constant factor a pass until they hold at most
   ``LIMIT`` rows (at once for tables of up to about a hundred million rows).
3. The last pass counts the distinct values inside the ranges; running sums
   over them, on top of the exact counts below, find both order statistics
   of each probability.

Ranks are checked against the exact counts: where a sketch was off, its
range is widened and the pass repeated, so results are exact always. A value
that holds a large part of all rows is a range of its own.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabspark.functions.columns import with_count_le
from tabspark.session import materialize

#: Size of a sketch (its rank error is about 2.3 / K**0.9), points that are read off it, the rank error that is allowed for.
SKETCH_K, GRID, ERROR = 4096, 1024, 0.002
#: Rows that a range may hold when its distinct values are counted.
LIMIT = 1_000_000
#: Passes after which ranges are taken as they are; each halves one at least.
PASSES = 64


def _nested(df: DataFrame, cols: Sequence[str], keep: Sequence[str | Column] = ()) -> DataFrame:
    """``(keep, feature, value)`` of the non-null values."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in cols])
    return df.select(*keep, F.explode(pairs).alias("_p")).select(*keep, "_p.*").where("value is not null")


def sketches(df: DataFrame, cols: Sequence[str], part: str | Column | None = None, k: int = SKETCH_K) -> DataFrame:
    """``(part, feature, n, n_nan, min, max, sketch)``: a KLL sketch per column and part of the table, to be kept.

    Not-a-numbers are counted apart (they are the largest values).
    """
    by = [] if part is None else [(F.col(part) if isinstance(part, str) else part).alias("part")]
    long = df.select(*by, *cols)
    real = F.when(~F.isnan("value"), F.col("value"))
    return (_nested(long, cols, ["part"] if by else []).groupBy(*(["part"] if by else []), "feature")
            .agg(F.count(real).alias("n"), F.sum(F.isnan("value").cast("bigint")).alias("n_nan"), F.min(real).alias("min"),
                 F.max(real).alias("max"), F.kll_sketch_agg_double(real, F.lit(k)).alias("sketch")))


def merge(parts: DataFrame) -> DataFrame:
    """``(feature, n, n_nan, min, max, sketch)`` of all parts together."""
    return parts.groupBy("feature").agg(
        F.sum("n").alias("n"), F.sum("n_nan").alias("n_nan"), F.min("min").alias("min"), F.max("max").alias("max"),
        F.kll_merge_agg_double("sketch").alias("sketch"))


def approximate(merged: DataFrame, probs: Sequence[float]) -> DataFrame:
    """``(feature, idx, prob, value)`` read off merged sketches; not-a-numbers don't count."""
    probs = [float(p) for p in probs]
    values = F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(p) for p in probs]))
    at = F.explode(F.array(*[F.struct(F.lit(i).cast("bigint").alias("idx"), F.lit(p).alias("prob"), F.col("_q")[i].alias("value"))
                             for i, p in enumerate(probs)]))
    return (merged.where("n > 0").select("feature", values.alias("_q")).select("feature", at.alias("_a"))
            .select("feature", "_a.*"))


def _grid(merged: DataFrame) -> DataFrame:
    """Sketches as the values at ``GRID + 1`` even ranks."""
    points = F.array(*[F.lit(i / GRID) for i in range(GRID + 1)])
    return merged.withColumn("grid", F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", points))).drop("sketch")


class _Ranges:
    """Disjoint closed value ranges of one column, each with the number of rows below it and what is known of its inside."""

    def __init__(self, ranks: set[int], n: int, lo: float, hi: float, grid: Sequence[float], below: int = 0):
        self.ranks, self.parts = ranks, [(lo, hi, below, n, list(grid))]
        self.cut: list[tuple[float, float]] = []

    def narrow(self, error: float) -> None:
        """Sets ``cut``: a range around each wanted rank, merged where they meet."""
        found = []
        for r in sorted(self.ranks):
            lo, hi, below, n, grid = next(p for p in self.parts if p[2] <= r < p[2] + p[3])
            a = math.floor(((r - below) / n - error) * GRID) - 1
            b = math.ceil(((r - below + 1) / n + error) * GRID) + 1
            found.append((grid[a] if a > 0 else lo, grid[b] if b < GRID else hi))
        self.cut = []
        for a, b in sorted(found):
            if self.cut and a <= self.cut[-1][1]:
                self.cut[-1] = (self.cut[-1][0], max(b, self.cut[-1][1]))
            else:
                self.cut.append((a, b))

    def shrinks(self, limit: int) -> bool:
        """Whether a cut holds more than ``limit`` rows and less than half of the range it was cut from, about."""
        for a, b in self.cut:
            lo, hi, below, n, grid = next(p for p in self.parts if p[0] <= a and b <= p[1])
            size = n * (sum(a <= g <= b for g in grid) + 2) / GRID
            if a < b and limit < size < n / 2:
                return True
        return False


def _coded(df: DataFrame, ranges: Mapping[str, _Ranges]) -> DataFrame:
    """``(feature, code, value)``: code 2i + 1 inside range i (from 0), 2i between the ranges before it and it."""
    out = df
    cells = []
    for c, r in ranges.items():
        x, n = F.col(c).cast("double"), len(r.cut)
        for side, k in (("lo", 0), ("hi", 1)):
            out = out.withColumn(f"__{side}_{c}", F.array(*[F.lit(float(p[k])) for p in r.cut]))
        out = with_count_le(out, f"__lo_{c}", x, n, f"__i_{c}")
        i = F.col(f"__i_{c}")
        inside = (i > 0) & (x <= F.try_element_at(F.col(f"__hi_{c}"), i.cast("int")))
        code = F.when(x.isNull(), None).when(inside, 2 * i - 1).otherwise(2 * i)
        cells.append(F.struct(F.lit(c).alias("feature"), code.cast("int").alias("code"),
                              F.when(inside, x).alias("value")))
    return out.select(F.explode(F.array(*cells)).alias("_c")).select("_c.*").where("code is not null")


def quantiles(df: DataFrame, probs: Mapping[str, Sequence[float]], stored: bool = False, limit: int = LIMIT,
              error: float = ERROR) -> DataFrame:
    """Exact ``(feature, idx, prob, value)`` of each column's own probabilities, like ``quantile_cont``.

    With n values and ``rn = (n - 1) * p``: ``lo + (hi - lo) * (rn - floor(rn))``.
    Nulls are ignored; not-a-number is the largest value. ``df`` is read two
    times or more: its columns are written once unless it is ``stored``.
    """
    cols = list(probs)
    own = df.select(*cols)
    own = own if stored else materialize(own)
    spark = df.sparkSession
    known = {r["feature"]: r for r in _grid(sketches(own, cols)).collect()}  # a row per column
    wants, ranges, tops = [], {}, {}
    for c in cols:
        if c not in known:
            continue
        r = known[c]
        ranks: set[int] = set()
        for i, p in enumerate(probs[c]):
            rn = (r["n"] + r["n_nan"] - 1) * float(p)
            lo, hi = math.floor(rn), math.ceil(rn)
            wants.append((c, i, float(p), rn, lo, hi))
            ranks |= {x for x in (lo, hi) if x < r["n"]}
        tops[c] = r["n"]
        if ranks:
            ranges[c] = _Ranges(ranks, r["n"], r["min"], r["max"], r["grid"])
    picked = _pick(own, ranges, limit, error)
    rows = []
    for c, i, p, rn, lo, hi in wants:
        a, b = (picked[c, x] if x < tops[c] else math.nan for x in (lo, hi))
        rows.append((c, i, p, a if lo == hi else a + (b - a) * (rn - lo)))
    return spark.createDataFrame(rows, "feature string, idx long, prob double, value double")


def _pick(own: DataFrame, ranges: dict[str, _Ranges], limit: int, error: float) -> dict[tuple[str, int], float]:
    """The value at each wanted rank; the driver gets a few rows per rank."""
    if not ranges:
        return {}
    for turn in itertools.count():
        for r in ranges.values():
            r.narrow(error)
        coded = _coded(own, ranges)
        if turn < PASSES and any(r.shrinks(limit) for r in ranges.values()):
            got = _grid(coded.groupBy("feature", "code").agg(
                F.count(F.lit(1)).alias("n"), F.min("value").alias("min"), F.max("value").alias("max"),
                F.kll_sketch_agg_double("value", F.lit(SKETCH_K)).alias("sketch"))
                .withColumn("n", F.when(F.col("code") % 2 == 1, F.col("n")).otherwise(-F.col("n")))).collect()
            if _refined(ranges, got):
                error = ERROR
            else:
                error = max(4 * error, 1 / GRID)
            continue
        counts = materialize(coded.groupBy("feature", "code", "value").agg(F.count(F.lit(1)).alias("cnt")))
        per = {(r["feature"], r["code"]): r["n"] for r in
               counts.groupBy("feature", "code").agg(F.sum("cnt").alias("n")).collect()}
        wanted = []
        for c, r in ranges.items():
            below, at = 0, {}
            for code in range(2 * len(r.cut) + 1):
                n = per.get((c, code), 0)
                at[code], below = (below, below + n), below + n
            for rank in r.ranks:
                code = next((k for k, (a, b) in at.items() if a <= rank < b), 0)
                if code % 2 == 0:
                    break
                wanted.append((c, code, rank, rank - at[code][0]))
            else:
                continue
            break
        else:
            spark = own.sparkSession
            want = spark.createDataFrame(wanted, "feature string, code int, rank long, nth long")  # a row per rank
            inside = counts.where(F.col("value").isNotNull())
            by = Window.partitionBy("feature", "code").orderBy("value")
            cum = inside.withColumn("upto", F.sum("cnt").over(by))
            hit = cum.join(F.broadcast(want), ["feature", "code"]).where(
                (F.col("nth") < F.col("upto")) & (F.col("nth") >= F.col("upto") - F.col("cnt")))
            return {(r["feature"], r["rank"]): r["value"] for r in hit.select("feature", "rank", "value").collect()}
        error = max(4 * error, 1 / GRID)


def _refined(ranges: dict[str, _Ranges], got: list) -> bool:
    """Takes over the ranges' exact counts and inner sketches if they hold all wanted ranks."""
    new = {}
    for c, r in ranges.items():
        own = {x["code"]: x for x in got if x["feature"] == c}
        below, parts = 0, []
        for code in range(2 * len(r.cut) + 1):
            x = own.get(code)
            if x is None:
                continue
            if code % 2:
                parts.append((x["min"], x["max"], below, x["n"], list(x["grid"])))
            below += abs(x["n"])
        if not all(any(p[2] <= rank < p[2] + p[3] for p in parts) for rank in r.ranks):
            return False
        new[c] = parts
    for c, parts in new.items():
        ranges[c].parts = parts
    return True
