"""Plan-level helpers."""

import os

from aulastar.sources.grid import spread


def test_spread_only_scans_with_fewer_partitions_than_cores(spark, tmp_root):
    p = os.path.join(tmp_root, "t.parquet")
    spark.range(1000).coalesce(1).write.parquet(p)
    df = spark.read.parquet(p)
    assert spread(df).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    many = spark.range(100).repartition(2 * spark.sparkContext.defaultParallelism)
    assert spread(many) is many
