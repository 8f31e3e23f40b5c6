"""Query op11: the 20 best rows of ``embeddings`` for every row whose id is divisible by 20."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabspark.llm import segment_search


def op11_segment_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment_search.top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0)


QUERIES = {"op11_segment_search": op11_segment_search}
SQL = {"op11_segment_search": """
with z as materialized (
  select vec_id, row_number() over () as uid, list_transform(embedding, lambda x: floor(64 * x::double)) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x::double))) = 0),
ranked as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score,
         row_number() over (partition by q.uid order by list_inner_product(q.v, c.v) desc, c.vec_id nulls last, c.uid) as rank
  from z q join z c on q.uid <> c.uid and len(q.v) = len(c.v) where q.vec_id % 20 = 0)
select query_id, rank::int as rank, vec_id, score from ranked where rank <= 20"""}
