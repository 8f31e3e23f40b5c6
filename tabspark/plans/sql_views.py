"""SQL text of the fixture views, for the DuckDB oracles.

Only the base tables are registered in the oracle engine, so each oracle
inlines the views it needs as CTEs: ``with_views('ex', body=...)``.
"""

from __future__ import annotations

_VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "li": ((), """
  select l_orderkey k, count(*) n_lines, sum(l_quantity) qty,
         sum(cast(round(l_extendedprice*100) as bigint)) gross_c,
         sum(cast(round(l_discount*100) as bigint)) disc_c,
         sum(cast(round(l_tax*100) as bigint)) tax_c,
         sum(cast(round(l_extendedprice*100) as bigint)*(100-cast(round(l_discount*100) as bigint))) net_4
  from lineitem group by l_orderkey"""),
    "ex": (("li",), """
  select o_orderkey as id, cast(n_lines as double) n_lines, qty total_quantity,
         cast(gross_c as double)/100 gross,
         cast(disc_c as double)/100/n_lines avg_discount,
         cast(tax_c as double)/100/n_lines avg_tax,
         c_acctbal acctbal,
         cast(gross_c as double)/100/qty price_per_unit,
         cast(net_4 as double)/10000/1000 net_k,
         cast(case when cast(net_4 as double)/10000 > 265000 then 1 else 0 end as double) is_high
  from orders join li on k = o_orderkey join customer on c_custkey = o_custkey"""),
    "digits": ((), "select vec_id id, label, embedding v from embeddings"),
    "reviews": ((), r"""
  select d.doc_id id, regexp_extract_all(lower(text), '\p{L}+|[?.!]', 0) terms,
         cast(quality as double) label
  from documents d join labels l on d.doc_id = l.doc_id"""),
    "doc_terms": ((), r"""
  select doc_id id, regexp_extract_all(lower(text), '\p{L}+|[?.!]', 0) terms
  from documents"""),
    "skewed": ((), "select event_id id, value from events"),
}


def _order(names: tuple[str, ...], seen: list[str]) -> list[str]:
    for n in names:
        deps, _ = _VIEWS[n]
        _order(deps, seen)
        if n not in seen:
            seen.append(n)
    return seen


def with_views(*names: str, ctes: str = "", body: str) -> str:
    """``with <views + extra ctes> <body>``; ``ctes`` is extra ``a as (...), b as (...)``."""
    parts = [f"{n} as ({_VIEWS[n][1]}\n)" for n in _order(names, [])]
    if ctes.strip():
        parts.append(ctes.strip().rstrip(","))
    if not parts:
        return body
    return "with " + ",\n".join(parts) + "\n" + body
