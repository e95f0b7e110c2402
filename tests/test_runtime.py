"""Run-time services."""

from pyspark.sql import functions as F

from millrace.runtime import stash


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f for f in (files.apply(i).getName() for i in range(files.size())) if f.startswith("shuffle_")}


def test_stash_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    out = stash(spark.range(10_000).repartition(3).groupBy((F.col("id") % 100).alias("k")).count(), "test")
    assert not shuffle_files(spark) - before
    assert out.count() == 100
