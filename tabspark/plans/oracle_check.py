"""Local twin of the driver's correctness gate.

Runs a named Spark query and its DuckDB SQL on the same parquet files and
compares row count, column names/types and an order-insensitive value
hash. Used by the tests; it starts no server.
"""

from __future__ import annotations

import hashlib
import math
from typing import Any

from tabspark.sources.tables import TABLES, table_path


def duckdb_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{table_path(sf_dir, t)}')")
    return con


def _norm(v: Any) -> Any:
    if v is None:
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(float(v))
    if isinstance(v, int):
        return str(v)
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    if isinstance(v, (list, tuple)):
        return [_norm(x) for x in v]
    if isinstance(v, dict):
        return {k: _norm(x) for k, x in sorted(v.items())}
    return str(v)


def _kind(type_name: str) -> str:
    """Type family with width: int32 / int64 / float32 / float64 / str / array / bool."""
    t = type_name.lower().strip()
    if t in ("int", "integer", "int32"):
        return "int32"
    if t in ("bigint", "long", "int64"):
        return "int64"
    if t in ("smallint", "short", "tinyint", "byte"):
        return "int16"
    if t in ("hugeint", "int128"):
        return "int128"
    if t in ("float", "real", "float32"):
        return "float32"
    if t in ("double", "float64"):
        return "float64"
    if "decimal" in t:
        return "decimal"
    if any(k in t for k in ("char", "string", "text")):
        return "str"
    if any(k in t for k in ("array", "[]", "list")):
        return "array"
    if "bool" in t:
        return "bool"
    return t


def digest(columns: list[str], kinds: list[str], rows: list[tuple]) -> tuple[int, list, str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    norm = [tuple(_norm(r[i]) for i in order) for r in rows]
    lines = sorted(repr(r) for r in norm)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return len(rows), [(columns[i], kinds[i]) for i in order], h


def compare(spark, sf_dir: str, name: str, query_fn, sql: str, con=None) -> dict:
    df = query_fn(spark, sf_dir)
    s_cols = df.columns
    s_kinds = [_kind(f.dataType.simpleString()) for f in df.schema.fields]
    s_rows = [tuple(r) for r in df.collect()]
    con = con or duckdb_connection(sf_dir)
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    d_kinds = [_kind(str(d[1])) for d in res.description]
    s = digest(s_cols, s_kinds, s_rows)
    d = digest(d_cols, d_kinds, d_rows)
    out = {"name": name, "rows": (s[0], d[0]), "schema_spark": s[1], "schema_sql": d[1],
           "rows_match": s[0] == d[0], "schema_match": s[1] == d[1], "hash_match": s[2] == d[2]}
    if not out["hash_match"] and s[0] == d[0]:
        o1 = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
        o2 = sorted(range(len(d_cols)), key=lambda i: d_cols[i])
        a = sorted(repr(tuple(_norm(r[i]) for i in o1)) for r in s_rows)
        b = sorted(repr(tuple(_norm(r[i]) for i in o2)) for r in d_rows)
        diffs = [(x, y) for x, y in zip(a, b) if x != y]
        out["n_diff"] = len(diffs)
        out["first_diff"] = diffs[:3]
    return out
