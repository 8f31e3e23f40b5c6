"""Query op13: five rounds of exact integer k-means over ``embeddings``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabspark.llm import ns_bounds

K, ROUNDS, DIM = 40, 5, 64


def seed_hash(salt: str = "2:"):
    return F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256)


def op13_ns_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    assigned, centroids = ns_bounds.cluster(vectors, K, ROUNDS, DIM, seed_hash())
    return ns_bounds.described(assigned, centroids).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _assigned(t: int) -> str:
    return f"""
a{t} as materialized (select uid, arg_min(j, (d, j)) as j, min(d) as d from (
  select uid, j, list_sum(list_transform(list_zip(z.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::bigint as d
  from z, c{t} c) group by uid)"""


def _moved(t: int) -> str:
    return f""",
s{t} as (select j, i, sum(x) as s, count(*) as n from p join a{t} using (uid) group by j, i),
m{t} as (select j, list(((s - ((s % n) + n) % n) // n)::bigint order by i) as v from s{t} group by j),
c{t + 1} as materialized (select j, coalesce(m.v, c.v) as v from c{t} c left join m{t} m using (j)),"""


QUERIES = {"op13_ns_bounds": op13_ns_bounds}
SQL = {"op13_ns_bounds": f"""
with z as materialized (
  select vec_id, row_number() over () as uid, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
  from embeddings where len(embedding) = {DIM} and len(list_filter(embedding, lambda x: x is null or not isfinite(x::double))) = 0),
p as materialized (select uid, generate_subscripts(v, 1) as i, unnest(v) as x from z),
c0 as materialized (select j, v from (
  select row_number() over (order by sha256('2:' || vec_id) nulls last, uid) - 1 as j, v from z) where j < {K}),
""" + "".join(_assigned(t) + _moved(t) for t in range(ROUNDS)) + _assigned(ROUNDS) + f"""
select vec_id, j::int as cluster, d as distance, (sum(d) over (partition by j))::bigint as cluster_inertia,
       (sum(d) over ())::bigint as inertia, sha256(array_to_string(c.v, ',')) as centroid_sha256
from a{ROUNDS} join z using (uid) join c{ROUNDS} c using (j)"""}
