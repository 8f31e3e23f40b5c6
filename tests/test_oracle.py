"""Every registered query against its DuckDB oracle (sf0.001), like the driver gate."""

import pytest

from tabspark.plans import catalog
from tabspark.plans.oracle_check import compare, duckdb_connection

from fixture_paths import SF_SMALL

SQL = catalog.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF_SMALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, SF_SMALL, name, catalog.get(name).fn, SQL[name], con)
    assert r["rows_match"] and r["schema_match"] and r["hash_match"], r


def test_entry_runs(spark):
    import __spark_entry__ as E

    rows = E.entry(spark).collect()
    assert sorted(r[0] for r in rows) == ["train", "valid"] and all(0 < r["rmse"] for r in rows)
    assert set(E.oracle_sql()) <= set(E.queries())
