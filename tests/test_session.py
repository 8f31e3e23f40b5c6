"""Scale helpers: size-checked broadcast, scan spreading, cluster sizing, checkpoints."""

from pyspark.sql import functions as F

from tabspark.operators.joins import bounded_broadcast
from tabspark.session import cluster_conf, ensure_checkpoint_dir, materialize
from tabspark.sources.views import spread


def test_bounded_broadcast_only_within_bound(spark):
    df = spark.range(100)
    assert bounded_broadcast(df, known_rows=1000, max_bytes=500) is df
    assert bounded_broadcast(df, max_bytes=500) is df  # 100 rows of more than 5 bytes
    wide = df.select(F.repeat(F.lit("x"), 1000).alias("s"))
    assert bounded_broadcast(wide, known_rows=100, max_bytes=50_000) is wide  # long rows are measured
    hinted = bounded_broadcast(df, max_bytes=50_000)
    assert hinted is not df
    assert "broadcast" in hinted._jdf.queryExecution().logical().toString().lower()


def test_spread_leaves_wide_scans_alone(spark):
    par = spark.sparkContext.defaultParallelism
    wide = spark.range(0, 1000, 1, par * 2)
    assert spread(wide, "id") is wide
    narrow = spark.range(0, 1000, 1, 1)
    assert spread(narrow, "id").rdd.getNumPartitions() == par


def test_cluster_conf_sizes_partitions():
    c = cluster_conf(100 * 10 ** 12, 8000)
    assert int(c["spark.sql.shuffle.partitions"]) >= 100 * 10 ** 12 // (256 << 20)
    assert cluster_conf(10 ** 6, 64)["spark.sql.shuffle.partitions"] == "128"


def test_materialize_uses_session_checkpoint_dir(spark):
    d = ensure_checkpoint_dir(spark)
    assert d and spark.sparkContext.getCheckpointDir()
    m = materialize(spark.range(10).select((F.col("id") * 2).alias("x")))
    assert m.agg(F.sum("x")).first()[0] == 90
