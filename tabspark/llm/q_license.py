"""Query op4: licence recognition over every document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabspark.llm import licenses


def op4_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return licenses.recognise(docs).select(
        "doc_id", F.size("sentence_ids").cast("long").alias("n_sentences"),
        F.array_join("sentence_ids", ",").alias("sentence_ids"),
        F.array_join("licenses", ",").alias("licenses"), "status")


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _sql() -> str:
    table = {licenses.normalised_pieces(s)[-1]: i for i, s in licenses.SENTENCES.items()}
    rows = ", ".join(f"({_q(k)}, {_q(v)})" for k, v in table.items())
    rules = ", ".join(f"({n}, {_q(name)}, {_q(licenses.rule_regex(steps))})"
                      for n, (name, steps) in enumerate(licenses.RULES))
    return f"""
with known(s, sid) as (values {rows}), rules(n, name, pat) as (values {rules}),
parts as (select doc_id, generate_subscripts(p, 1) as pos, unnest(p) as s from (
  select doc_id, regexp_split_to_array(coalesce(text, ''), '{licenses.SENTENCE_END}') as p from documents)),
ids as (select doc_id, count(*) as n, string_agg(sid, ',' order by pos) as ids,
               ' ' || string_agg(sid, '  ' order by pos) || ' ' as seq
        from parts join known on trim(regexp_replace(lower(parts.s), '{licenses.NOT_WORD}', ' ', 'g')) = known.s
        group by doc_id),
met as (select doc_id, name, min(n) as n from (
          select ids.doc_id, rules.name, rules.n from ids join rules on regexp_matches(ids.seq, rules.pat)) group by all),
lic as (select doc_id, string_agg(name, ',' order by n) as l from met group by doc_id)
select d.doc_id, coalesce(ids.n, 0)::bigint as n_sentences, coalesce(ids.ids, '') as sentence_ids,
       coalesce(lic.l, '') as licenses,
       case when lic.l is not null then 'matched' when ids.n > 0 then 'unmatched' else 'none' end as status
from documents d left join ids using (doc_id) left join lic using (doc_id)"""


QUERIES = {"op4_license_rules": op4_license_rules}
SQL = {"op4_license_rules": _sql()}
