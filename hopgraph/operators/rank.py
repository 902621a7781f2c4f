"""Ranks over a whole table without a single-task window (O1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hopgraph.session import written


def ranked(df: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """``df`` with its gapless row number from 1 in ``order`` (as ``ROW_NUMBER() OVER (ORDER BY ...)``).

    Rows are range-partitioned in order; a partition's rows are numbered from
    the count of all partitions before it.  ``order`` should end in a unique
    column: equal rows share a partition, and are numbered in any order.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = written(df.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()), "ranked")
    counts = cut.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))          # one row a partition
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_part").orderBy(*order)
    return (cut.withColumn("_row", F.row_number().over(inside)).join(offsets, "_part")
            .withColumn(name, F.col("_before") + F.col("_row")).drop("_part", "_row", "_before"))
