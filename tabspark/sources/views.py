"""Example views derived from the driver tables (see FIXTURES.md §3).

``ex``      one row per order with lines: 7 numeric features, regression
            target ``net_k``, binary target ``is_high``; key ``id``.
``digits``  ``embeddings`` as ``(id, label, v ARRAY<FLOAT>)``.
``reviews`` English documents with a quality label, as term lists.
``skewed``  ``events.value`` keyed by ``event_id``.

Money is summed as BIGINT cents, which is exact in any order, so the
view is bit-equal to its SQL twin on any cluster layout.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabspark.functions.columns import terms_of
from tabspark.sources.tables import read_table

EX_FEATURES = ("n_lines", "total_quantity", "gross", "avg_discount", "avg_tax", "acctbal",
               "price_per_unit")
# Fixed value: the reference's threshold on the house value, applied to net.
HIGH_VALUE_THRESHOLD = 265000.0


def _cents(c: str):
    return F.round(F.col(c) * 100).cast("bigint")


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-order line totals; one shuffle on ``l_orderkey`` with map-side combine."""
    li = read_table(spark, sf_dir, "lineitem",
                    ["l_orderkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    return li.groupBy(F.col("l_orderkey").alias("k")).agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum("l_quantity").alias("qty"),
        F.sum(_cents("l_extendedprice")).alias("gross_c"),
        F.sum(_cents("l_discount")).alias("disc_c"),
        F.sum(_cents("l_tax")).alias("tax_c"),
        F.sum(_cents("l_extendedprice") * (F.lit(100) - _cents("l_discount"))).alias("net_4"),
    )


def ex(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The example table (stand-in for the housing table)."""
    li = order_lines(spark, sf_dir)
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey"])
    cust = read_table(spark, sf_dir, "customer", ["c_custkey", "c_acctbal"])
    # orders join the aggregate on its own grouping key: the aggregate's
    # hash partitioning is reused, only orders is shuffled. customer is
    # broadcast by Catalyst when its statistics fit the threshold, else
    # sort-merge (AQE splits a hot customer key).
    j = (orders.join(li, orders.o_orderkey == li.k)
         .join(cust, cust.c_custkey == orders.o_custkey))
    gross = F.col("gross_c").cast("double") / 100
    net = F.col("net_4").cast("double") / 10000
    return j.select(
        F.col("o_orderkey").alias("id"),
        F.col("n_lines").cast("double").alias("n_lines"),
        F.col("qty").alias("total_quantity"),
        gross.alias("gross"),
        (F.col("disc_c").cast("double") / 100 / F.col("n_lines")).alias("avg_discount"),
        (F.col("tax_c").cast("double") / 100 / F.col("n_lines")).alias("avg_tax"),
        F.col("c_acctbal").alias("acctbal"),
        (gross / F.col("qty")).alias("price_per_unit"),
        (net / 1000).alias("net_k"),
        F.when(net > F.lit(HIGH_VALUE_THRESHOLD), F.lit(1)).otherwise(F.lit(0))
        .cast("double").alias("is_high"),
    )


def digits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("label"), F.col("embedding").alias("v"))


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash-spread a scan that yields fewer partitions than the cluster has
    cores, before CPU-heavy per-row work (tokenising whole texts). A wide
    scan (the normal case on a large table) is returned untouched, so no
    shuffle is added at scale."""
    par = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < par:
        return df.repartition(par, key)
    return df


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents of all languages: ``(id, terms, label)``; only they are tokenised."""
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    labels = read_table(spark, sf_dir, "labels", ["doc_id", "quality"])
    par = spark.sparkContext.defaultParallelism
    j = docs.join(labels, "doc_id")
    # The scan's partitions are asked for, not the join's: that would run its shuffle of whole texts a second time.
    j = j.repartition(par, "doc_id") if docs.rdd.getNumPartitions() < par else j
    return j.select(F.col("doc_id").alias("id"), terms_of("text").alias("terms"),
                    F.col("quality").cast("double").alias("label"))


def document_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as term lists; a stream for term counts, never written."""
    docs = spread(read_table(spark, sf_dir, "documents", ["doc_id", "text"]), "doc_id")
    return docs.select(F.col("doc_id").alias("id"), terms_of("text").alias("terms"))


def skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events", ["event_id", "value"]).select(
        F.col("event_id").alias("id"), "value")
