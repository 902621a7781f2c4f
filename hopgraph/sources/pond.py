"""Size-cut Parquet landing."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hopgraph.session import written

TARGET_FILE_BYTES = 300 << 20


def file_numbers(df: DataFrame, target_bytes: int) -> DataFrame:
    """(``row``, ``file``): the file of every row, by running byte sums over all rows.

    Rows are numbered and written once, so that the totals of the partitions
    and the sums inside them see the same cut.  A row's size is the length of
    its JSON text, like the crawler's string-length estimate.  The file is the
    one in which the row begins, so every file but the last is within one row
    of the target.
    """
    rows = df.select(F.struct(*df.columns).alias("row"), F.monotonically_increasing_id().alias("number"),
                     F.spark_partition_id().alias("part"))
    rows = written(rows.withColumn("size", F.length(F.to_json("row")).cast("long")), "pond-rows")
    totals = rows.groupBy("part").agg(F.sum("size").alias("size"))            # one row a partition
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    begin = F.col("offset") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    return rows.join(offsets, "part").select("row", F.floor(begin / target_bytes).cast("int").alias("file"))


def write_pond(df: DataFrame, path: str, target_bytes: int = TARGET_FILE_BYTES) -> int:
    """Write ``df`` as Parquet files cut where the running size crosses ``target_bytes``.

    One task writes one file; a small input is one file.  Returns the number of files.
    """
    placed = written(file_numbers(df, target_bytes), "pond-placed")
    files = (placed.agg(F.max("file")).first()[0] or 0) + 1
    placed.repartitionById(files, F.col("file")).select("row.*").write.parquet(path)
    return files
