"""Queries: batch, epoch and padding plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabspark.plans.q_core import ex
from tabspark.plans.registry import query
from tabspark.plans.sql_views import with_views
from tabspark.sources import views
from tabspark.streaming import batches

BATCH = 100
EPOCHS = 2
PAD_BATCH = 25

B_SQL = f"""b as (select id, (row_number() over (order by md5('42-' || id), id) - 1) // {BATCH} as batch_id from ex)"""


@query("batch_assign", "B8", with_views("ex", ctes=B_SQL, body="""
select id, row_number() over (order by md5('42-' || id), id) as rank, batch_id from b"""))
def batch_assign(spark, d):
    return batches.batch_assign(ex(spark, d).select("id"), BATCH)


@query("epoch_plan", "B9,B10", with_views("ex", ctes=B_SQL + f""",
bo as (select epoch, batch_id, row_number() over (partition by epoch order by md5('42-' || epoch || '-' || batch_id), batch_id)
              as batch_order from (select distinct batch_id from b) t, (select range as epoch from range({EPOCHS})) e)""",
                                          body="select bo.epoch, bo.batch_order, b.batch_id, b.id from b join bo on b.batch_id = bo.batch_id"))
def epoch_plan(spark, d):
    return batches.epoch_plan(ex(spark, d).select("id"), BATCH, EPOCHS, mode="batches")


@query("epoch_plan_rows", "B9,B10", with_views("ex", body=f"""
select epoch, (row_number() over (partition by epoch order by md5('42-' || epoch || '-' || id), id) - 1) // {BATCH} as batch_order,
       (row_number() over (partition by epoch order by md5('42-' || epoch || '-' || id), id) - 1) // {BATCH} as batch_id, id
from ex, (select range as epoch from range({EPOCHS})) e"""))
def epoch_plan_rows(spark, d):
    return batches.epoch_plan(ex(spark, d).select("id"), BATCH, EPOCHS, mode="rows")


@query("padded_batch", "B11", with_views("reviews", ctes=f"""
b as (select id, terms, (row_number() over (order by md5('42-' || id), id) - 1) // {PAD_BATCH} as batch_id from reviews),
w as (select *, max(len(terms)) over (partition by batch_id) as width from b)""", body="""
select id, batch_id, cast(width as bigint) as width,
       md5(array_to_string(terms || list_transform(range(width - len(terms)), lambda i: ''), ' ')) as padded_md5,
       cast(width as bigint) as padded_len
from w"""))
def padded_batch(spark, d):
    p = batches.padded_batch(views.reviews(spark, d).select("id", "terms"), "terms", PAD_BATCH)
    return p.select("id", "batch_id", "width", F.md5(F.array_join("padded", " ")).alias("padded_md5"),
                    F.size("padded").cast("bigint").alias("padded_len"))
