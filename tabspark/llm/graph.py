"""Connected components of a link table, in Spark jobs only."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabspark.llm.tasks import stored
from tabspark.session import ensure_checkpoint_dir


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` of every node that has a link; component is the smallest node reachable.

    Alternating large and small stars: every round is two aggregations and
    two joins over the links, written to the checkpoint folder, until a
    round changes nothing. Links to oneself, repeated links and nulls are
    ignored. A node with many links is a skewed join key, never one group.
    Joins are by sorting: nodes that are no plain numbers would take a page
    of 64 MB of the driver for each small table that is broadcast.

    A round's links lie as Parquet, in two folders by turns. A checkpoint
    keeps the size that was estimated for its plan, for a join the product
    of its sides: over rounds that is a number whose digits double with every
    join, until it fills the driver. Files are estimated by their sizes.
    """
    spark = links.sparkSession
    folder = f"{ensure_checkpoint_dir(spark)}/components-{uuid.uuid4().hex}"

    def kept(round_: int, df: DataFrame) -> DataFrame:
        path = f"{folder}/{round_ % 2}"
        df.write.mode("overwrite").parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    cur = kept(0, links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
               .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    seen, round_ = None, 0
    while True:
        state = cur.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v") % F.lit(1 << 31)).alias("h")).first()
        if state == seen:
            return (cur.select(F.col("u").alias("node"), F.col("v").alias("component"))
                    .unionByName(cur.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))
        seen, round_ = state, round_ + 1
        # Both sides of a join are written, so that the partitions of a node with very many links can be split.
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = stored(both.where(F.col("v") > F.col("u")).join(low.hint("merge"), "u")
                       .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = stored(large.groupBy("u").agg(F.min("v").alias("m")))
        small = (large.join(low.hint("merge"), "u").where(F.col("v") != F.col("m"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")))
        cur = kept(round_, small.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
