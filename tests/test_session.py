from pyspark.sql import functions as F

from tessera import session as S
from tessera.operators.parallelism import spread


def test_cut_lineage_round_trip(spark):
    df = spark.range(0, 1000).select(F.col("id"), (F.col("id") % 7).alias("k"), F.array("id").alias("a"))
    out = S.cut_lineage(df)
    assert out.schema.simpleString() == df.schema.simpleString()
    assert out.exceptAll(df).count() == 0 and out.count() == 1000
    path = S.ensure_checkpoint_dir(spark)
    assert path and path == spark.sparkContext.getCheckpointDir()
    empty = S.cut_lineage(df.where("id < 0"))
    assert empty.count() == 0 and empty.columns == df.columns


def test_scope_deletes_its_tables(spark):
    import os
    folder = S.ensure_checkpoint_dir(spark).removeprefix("file:").rstrip("/") + "/tables"
    outside = S.cut_lineage(spark.range(5))
    before = set(os.listdir(folder))
    with S.scratch_scope(spark):
        assert S.cut_lineage(spark.range(10)).count() == 10 and len(os.listdir(folder)) == len(before) + 1
    assert set(os.listdir(folder)) == before and outside.count() == 5


def test_ship_package_is_idempotent(spark):
    S.ship_package(spark)
    S.ship_package(spark)
    assert spark.sparkContext.applicationId in S._SHIPPED


def test_spread_never_lowers_the_number_of_partitions(spark):
    one = spark.range(0, 100, 1, 1)
    assert spread(one).rdd.getNumPartitions() >= one.rdd.getNumPartitions()
