"""Bucketization, categorical encodings and embeddings.

Exact quantiles are those of ``operators.quantile``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabspark.functions.columns import attach_row, bucket_of, in_range, md5_bucket, with_count_le
from tabspark.operators import quantile
from tabspark.operators.joins import bounded_broadcast
from tabspark.session import materialize


def probs_i_over_n(n: int) -> list[float]:
    """Boundaries at i/n for i = 1..n-1 (n buckets)."""
    return [i / n for i in range(1, n)]


def probs_i_over_n_plus_1(n: int) -> list[float]:
    """Boundaries at (i+1)/(n+1) for i = 0..n-1 (n boundaries)."""
    return [(i + 1) / (n + 1) for i in range(n)]


def unpivot(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = (),
            name: str = "feature", value: str = "value") -> DataFrame:
    """Wide numeric columns -> long ``(keep..., feature, value DOUBLE)``."""
    pairs = F.array(*[F.struct(F.lit(c).alias(name), F.col(c).cast("double").alias(value)) for c in cols])
    return df.select(*keep, F.explode(pairs).alias("_kv")).select(*keep, f"_kv.{name}", f"_kv.{value}")


def quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], approx: bool = False,
              stored: bool = False) -> DataFrame:
    """Per column and probability: ``(feature, idx, prob, value)``, exact or read off one pass' sketches.

    ``idx`` is the 0-based position of the probability. Nulls are ignored.
    """
    if approx:
        return quantile.approximate(quantile.sketches(df, cols), probs)
    return quantile.quantiles(df, {c: probs for c in cols}, stored)


def boundaries_row(q: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Quantile table -> one row with an ordered ``<col>__bounds`` array per column."""
    per = q.groupBy("feature").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("idx", "value"))), lambda s: s["value"])
        .alias("b"))
    return per.agg(*[F.first(F.when(F.col("feature") == c, F.col("b")), ignorenulls=True)
                     .alias(f"{c}__bounds") for c in cols])


def bucketize(df: DataFrame, bounds: DataFrame, cols: Sequence[str], keep: Sequence[str] = ("id",),
              suffix: str = "", n_bounds: int | Mapping[str, int] | None = None) -> DataFrame:
    """Bucket id per column = number of boundaries <= x.

    With ``n_bounds`` (sorted quantile bounds of known length) each id is a
    code-generated binary search; otherwise a per-row filter over the bounds
    (any order, duplicates allowed).
    """
    j = attach_row(df, bounds)
    if n_bounds is None:
        return j.select(*keep, *[bucket_of(c, f"{c}__bounds").alias(f"{c}{suffix}") for c in cols])
    for c in cols:
        n = n_bounds if isinstance(n_bounds, int) else n_bounds[c]
        j = with_count_le(j, f"{c}__bounds", F.col(c).cast("double"), n, f"__b_{c}")
    return j.select(*keep, *[F.col(f"__b_{c}").alias(f"{c}{suffix}") for c in cols])


def bucketize_by_quantiles(df: DataFrame, cols: Sequence[str], n_buckets: int | Mapping[str, int],
                           fit_on: DataFrame | None = None, keep: Sequence[str] = ("id",),
                           approx: bool = False, stored: bool = False) -> DataFrame:
    """i/n quantile boundaries from ``fit_on`` (training rows), applied to ``df``.

    ``n_buckets`` is one number, or one for each column; all columns'
    boundaries come from the same passes. ``stored``: ``fit_on`` need not be
    written before it is read more than once.
    """
    per = {c: n_buckets if isinstance(n_buckets, int) else n_buckets[c] for c in cols}
    source = fit_on if fit_on is not None else df
    if approx:
        merged = materialize(quantile.sketches(source, cols))
        parts = [quantile.approximate(merged.where(F.col("feature").isin([c for c in cols if per[c] == n])), probs_i_over_n(n))
                 for n in sorted(set(per.values()))]
        q = parts[0]
        for part in parts[1:]:
            q = q.unionByName(part)
    else:
        q = quantile.quantiles(source, {c: probs_i_over_n(n) for c, n in per.items()}, stored)
    return bucketize(df, boundaries_row(q, cols), cols, keep, n_bounds={c: n - 1 for c, n in per.items()})


def bucketize_fixed(x: str | Column, bounds: Sequence[float]) -> Column:
    """Bucket by literal boundaries."""
    return bucket_of(x, list(bounds))


def range_one_hot(df: DataFrame, col: str, starts: Sequence[float], width: float,
                  prefix: str, keep: Sequence[str] = ("id",)) -> DataFrame:
    """One 0/1 column per half-open range ``[s, s + width)``."""
    cols = [in_range(col, s, s + width).alias(f"{prefix}_{int(s)}_to_{int(s + width)}") for s in starts]
    return df.select(*keep, *cols)


def range_bins(spark, starts: Sequence[float], width: float) -> DataFrame:
    """Bin table ``(bin, lo, hi)`` for D7."""
    return spark.createDataFrame([(i, float(s), float(s + width)) for i, s in enumerate(starts)],
                                 "bin long, lo double, hi double")


def range_bin_join(df: DataFrame, col: str, bins: DataFrame, keep: Sequence[str] = ("id",)) -> DataFrame:
    """Long-form bins via a range join on a small broadcast bin table.

    The bin table is a parameter (a handful of rows): the plan is a
    BroadcastNestedLoopJoin that streams ``df`` without shuffling it.
    """
    b = F.broadcast(bins)
    j = df.join(b, (F.col(col) >= b["lo"]) & (F.col(col) < b["hi"]))
    return j.select(*keep, "bin")


def one_hot_long(df: DataFrame, idx: str, k: int, keep: Sequence[str] = ("id",)) -> DataFrame:
    """D10 in long form: ``(keep..., k, bit)`` for k in 0..k-1."""
    return (df.select(*keep, idx, F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("k"))
            .select(*keep, F.col("k").cast("bigint").alias("k"),
                    F.when(F.col("k") == F.col(idx), 1).otherwise(0).alias("bit")))


def cross_exact(a: str | Column, b: str | Column, b_buckets: int) -> Column:
    """Exact cross id of two bucket ids, ``a * nb + b``."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    return (a * F.lit(b_buckets) + b).cast("bigint")


def cross_hashed(a: str | Column, b: str | Column, buckets: int = 1000) -> Column:
    """Hashed cross of two bucket ids into ``buckets`` slots."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    return md5_bucket(F.concat(a.cast("string"), F.lit("_"), b.cast("string")), buckets)


# ---------------------------------------------------------------- vocabulary

def explode_terms(df: DataFrame, terms: str = "terms", key: str = "id") -> DataFrame:
    return df.select(key, F.explode(terms).alias("term"))


def vocab_distinct(df: DataFrame, terms: str = "terms") -> DataFrame:
    """Distinct terms."""
    return df.select(F.explode(terms).alias("term")).distinct()


def vocab_topk(df: DataFrame, k: int, terms: str = "terms", key: str = "id") -> DataFrame:
    """The ``k`` terms of highest document frequency (ties by term),
    ``(term, pos, df)``; ``pos`` is the 0-based vocabulary position.

    Per-document ``array_distinct`` then a count per term (map-side
    combine); the top-k is a bounded heap, and the numbering window runs
    over those ``k`` rows only.
    """
    dfreq = (df.select(key, F.explode(F.array_distinct(terms)).alias("term"))
             .groupBy("term").agg(F.count(F.lit(1)).alias("df")))
    top = dfreq.orderBy(F.col("df").desc(), F.col("term")).limit(k)
    w = Window.orderBy(F.col("df").desc(), F.col("term"))
    return top.select("term", (F.row_number().over(w) - 1).cast("bigint").alias("pos"), "df")


def vocab_from_terms(spark, terms: Sequence[str]) -> DataFrame:
    """A5: a literal vocabulary ``(term, pos)``."""
    return spark.createDataFrame([(t, i) for i, t in enumerate(terms)], "term string, pos long")


def vocab_lookup(df: DataFrame, vocab: DataFrame, terms: str = "terms", key: str = "id",
                 vocab_rows: int | None = None) -> DataFrame:
    """``(id, term_pos, n)``: in-vocabulary terms with their counts.

    Terms outside the vocabulary are dropped (inner join). ``vocab_rows``
    is the vocabulary's size bound (top-k, literal list); the broadcast is
    size-checked (``joins.bounded_broadcast``).
    """
    v = bounded_broadcast(vocab.select("term", F.col("pos").alias("term_pos")), vocab_rows)
    return (explode_terms(df, terms, key).join(v, "term")
            .groupBy(key, "term_pos").agg(F.count(F.lit(1)).alias("n")))


def vocab_semi(df: DataFrame, vocab: DataFrame, terms: str = "terms", key: str = "id",
               vocab_rows: int | None = None) -> DataFrame:
    """E5: keep term occurrences whose term is in the vocabulary (semi-join)."""
    return explode_terms(df, terms, key).join(bounded_broadcast(vocab.select("term"), vocab_rows), "term",
                                              "left_semi")


def multi_hot_indices(df: DataFrame, vocab: DataFrame, terms: str = "terms", key: str = "id",
                      vocab_rows: int | None = None) -> DataFrame:
    """Sorted vocabulary positions present in each row: the sparse
    multi-hot vector ``(id, idx ARRAY<BIGINT>)``. Rows without a hit keep
    an empty array (left join). Each array is bounded by the vocabulary.
    """
    hits = vocab_lookup(df, vocab, terms, key, vocab_rows)
    idx = hits.groupBy(key).agg(F.array_sort(F.collect_list("term_pos")).alias("idx"))
    return (df.select(key).join(idx, key, "left")
            .select(key, F.coalesce("idx", F.array().cast("array<bigint>")).alias("idx")))


def oov_buckets(df: DataFrame, vocab: DataFrame, n_oov: int, terms: str = "terms",
                key: str = "id", vocab_rows: int | None = None) -> DataFrame:
    """In-vocabulary terms keep their position; other terms hash into
    ``n_oov`` extra slots after it. ``(id, slot, n)``."""
    size = vocab.agg(F.count(F.lit(1)).alias("_v"))
    ex = explode_terms(df, terms, key)
    j = attach_row(ex.join(bounded_broadcast(vocab.select("term", "pos"), vocab_rows), "term", "left"), size)
    slot = F.coalesce(F.col("pos"), F.col("_v") + md5_bucket("term", n_oov)).cast("bigint")
    return j.groupBy(key, slot.alias("slot")).agg(F.count(F.lit(1)).alias("n"))


def embed(df: DataFrame, table: DataFrame, dims: int, combiner: str = "mean",
          terms: str = "terms", key: str = "id", table_rows: int | None = None) -> DataFrame:
    """Combine the vectors of the terms present.

    ``table`` is ``(term, e0..e{dims-1})`` (bounded by the vocabulary, so
    broadcast); the one-hot x matrix product becomes this row lookup.
    Every occurrence counts; ``combiner`` is ``sum`` or ``mean``.
    """
    agg = F.sum if combiner == "sum" else F.avg
    j = explode_terms(df, terms, key).join(bounded_broadcast(table, table_rows), "term")
    return j.groupBy(key).agg(*[agg(f"e{i}").alias(f"e{i}") for i in range(dims)])


def nearest_by_dot(table: DataFrame, dims: int, k: int, key: str = "term", max_rows: int = 10_000) -> DataFrame:
    """For each row of a small embedding table, the ``k`` other rows of
    largest dot product ``(key, rank, other, dot)``; ties by ``other``.

    The table is a vocabulary (bounded by its top-k parameter): it is
    packed into one broadcast array and every row scores against that
    array, so no pair table is ever materialized or shuffled. A table of
    more than ``max_rows`` rows raises.
    """
    if table.limit(max_rows + 1).count() > max_rows:
        raise ValueError(f"nearest_by_dot is for tables of at most {max_rows} rows")
    vec = F.array(*[F.col(f"e{i}").cast("double") for i in range(dims)])
    packed = table.agg(F.collect_list(F.struct(F.col(key).alias("o"), vec.alias("ov"))).alias("_all"))
    me = table.select(F.col(key), vec.alias("v"))
    j = attach_row(me, packed)
    scored = F.transform(
        F.filter("_all", lambda s: s["o"] != F.col(key)),
        lambda s: F.struct(
            (-F.aggregate(F.zip_with(F.col("v"), s["ov"], lambda a, b: a * b), F.lit(0.0), lambda acc, x: acc + x))
            .alias("neg_dot"),
            s["o"].alias("other")))
    top = j.select(key, F.slice(F.sort_array(scored), 1, k).alias("_top"))
    return top.select(key, F.posexplode("_top").alias("_r", "_s")).select(
        key, (F.col("_r") + 1).cast("bigint").alias("rank"), F.col("_s.other").alias("other"),
        (-F.col("_s.neg_dot")).alias("dot"))
