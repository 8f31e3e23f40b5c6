"""Exact most frequent values by sketch and recount; widening where the proof fails."""

from collections import Counter

import pytest

from tabspark.operators import frequent


def frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x string").repartition(5)


def want(values, k):
    return sorted(Counter(v for v in values if v is not None).items(), key=lambda t: (-t[1], t[0]))[:k]


def got(df, k, **how):
    top, tracked = frequent.top_counts(df, "x", k, **how)
    return sorted(((r.value, r.n) for r in top.collect()), key=lambda t: (-t[1], t[0])), tracked


def test_heavy_values_are_proven(spark):
    values = [f"hot{i}" for i in range(6) for _ in range(400 + 10 * i)] + [f"rare{i}" for i in range(4000)] + [None] * 50
    assert got(frame(spark, values), 5, tracked=256) == (want(values, 5), 256)


def test_flat_counts_widen_and_end_in_a_full_count(spark):
    values = [f"v{i:04}" for i in range(3000) for _ in range(2)]
    assert got(frame(spark, values), 4, tracked=32, most=64) == (want(values, 4), 0)
    found, tracked = got(frame(spark, values), 4, tracked=32, most=1 << 19)
    assert found == want(values, 4) and tracked != 32


@pytest.mark.parametrize("values", [[], [None], ["a"], ["b", "a", "b", "c", "a"]])
def test_small_tables_and_ties(spark, values):
    assert got(frame(spark, values), 3)[0] == want(values, 3)


def test_k_is_checked(spark):
    with pytest.raises(ValueError):
        frequent.top_counts(frame(spark, ["a"]), "x", 0)
