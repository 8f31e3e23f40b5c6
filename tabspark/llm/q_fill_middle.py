"""Query op12: every document in fill-in-middle form, and read back from it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabspark.llm import fill_middle
from tabspark.llm.tasks import bounded_batches


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    done = fill_middle.transform(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return done.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(fill_middle.restore("output", "form"), 256).alias("restored_sha256"))


QUERIES = {"op12_fill_middle": op12_fill_middle}
SQL = {"op12_fill_middle": """
with d as (select doc_id, coalesce(text, '') as t, sha256('1:' || coalesce(doc_id::varchar, '')) as h from documents),
e as (select doc_id, t, length(t) as n, ('0x' || substr(h, 1, 8))::bigint as h1, ('0x' || substr(h, 9, 8))::bigint as h2,
             ('0x' || substr(h, 17, 8))::bigint as h3, ('0x' || substr(h, 25, 8))::bigint as h4 from d),
f as (select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
             case when n = 0 or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 90 then 'plain'
                  when h4 % 100 < 20 then 'spm' else 'psm' end as form from e),
g as (select *, '<P>' || substr(t, 1, a) as p, '<M>' || substr(t, a + 1, b - a) as m, '<S>' || substr(t, b + 1) as s from f)
select doc_id, n::bigint as n, form, case when form <> 'plain' then a::bigint end as prefix_chars,
       case when form <> 'plain' then (b - a)::bigint end as middle_chars,
       sha256(case form when 'plain' then t when 'spm' then s || p || m else p || s || m end) as output_sha256,
       sha256(t) as restored_sha256
from g"""}
