"""Ranks and running totals over one global order, without a window that holds all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.runtime import stash


def running_total(df: DataFrame, order: list[str], value: str, name: str = "before") -> DataFrame:
    """``df`` with the sum of ``value`` over all rows that come before in ``order``.

    Rows are cut into ranges of ``order`` (which should end in a unique column), each range keeps its own running
    sum, and the ranges' totals, one number for each partition, are summed up on the driver.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *order).withColumn("_range", F.spark_partition_id())
    kept = stash(ranged, "ranges")
    totals = {r[0]: r[1] for r in kept.groupBy("_range").agg(F.sum(value)).collect()}
    offset, offsets = 0, {}
    for part in sorted(totals):
        offsets[part] = offset
        offset += totals[part] or 0
    if not offsets:
        return df.withColumn(name, F.lit(0).cast("bigint"))
    start = F.try_element_at(F.create_map(*[F.lit(x) for kv in offsets.items() for x in kv]), F.col("_range"))
    window = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return kept.withColumn(name, start + F.sum(value).over(window) - F.col(value)).drop("_range")
