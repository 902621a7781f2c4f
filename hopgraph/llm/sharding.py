"""Operator 3: contiguous shards of equal bytes by global prefix sums.

Documents in (doc_id, crc32) order are cut into ``n_shards`` contiguous shards
of near-equal bytes.  Light rows are range-partitioned; each partition's total
gives its offset, a running sum inside the partition gives every document its
global byte position, and the position of its middle byte picks the shard.  A
shard is off the equal share by less than one document at each end.

Cases: a NULL text has size 1 (nothing plus 1) and a NULL checksum; NULL ids
come first; repeated ids, texts or whole rows are ordered by checksum, then by
a row number that is drawn once and written, so ties may spread over
partitions and shards; an empty table gives an empty result; the input row is
carried as a struct.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hopgraph.llm.common import table, written

N_SHARDS = 8
LAW = "bytes"
ROWS_PER_PARTITION = 2_000_000      # light rows (about 40 bytes each) in one range partition


def positions(light: DataFrame) -> DataFrame:
    """Light rows (``doc_id``, ``crc``, ``size``, ``rid``) with global ``start`` and ``number``.

    The partition number is written with the rows, so that totals and running
    sums see the same cut even if a task is rerun.  The partition totals, one
    row for each partition, are summed in order by one small window.
    """
    spark = light.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")),
            light.count() // ROWS_PER_PARTITION + 1)
    order = ["doc_id", "crc", "rid"]
    cut = written(light.repartitionByRange(n, *order).withColumn("part", F.spark_partition_id()), "shard-light")
    totals = cut.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("b0"),
                            F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("r0"))
    inside = Window.partitionBy("part").orderBy(*order)
    run = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (cut.withColumn("_b", F.sum("size").over(run)).withColumn("_r", F.row_number().over(inside))
            .join(offsets, "part")
            .withColumn("start", F.col("b0") + F.col("_b") - F.col("size"))
            .withColumn("number", F.col("r0") + F.col("_r") - 1)
            .drop("part", "b0", "r0", "_b", "_r"))


def assign(light: DataFrame, n_shards: int = N_SHARDS) -> DataFrame:
    """``rid``, ``doc_id``, ``size``, ``crc`` with ``shard`` and ``slot`` (gapless from 0 in each shard)."""
    placed = written(positions(light), "shard-placed")
    whole = placed.agg(F.sum("size").alias("s")).scalar()
    middle = (F.col("start") * 2 + F.col("size")) * n_shards
    df = (placed.withColumn("_middle", middle).withColumn("_whole", whole * 2)
          .withColumn("shard", F.least(F.lit(n_shards - 1), F.expr("_middle div _whole").cast("int"))))
    first = df.groupBy("shard").agg(F.min("number").alias("first"))   # n_shards rows
    return (df.join(F.broadcast(first), "shard")
            .select("rid", "doc_id", "size", "crc", "shard", (F.col("number") - F.col("first")).alias("slot")))


def _light(docs: DataFrame) -> DataFrame:
    raw = F.col("_row.text").cast("binary")
    return docs.select(F.col("_row.doc_id").alias("doc_id"), F.crc32(raw).alias("crc"),
                       (F.coalesce(F.octet_length(raw), F.lit(0)).cast("long") + 1).alias("size"), "rid")


def shard_documents(docs: DataFrame, n_shards: int = N_SHARDS) -> DataFrame:
    """The rows of ``docs`` (struct ``_row``) with size, checksum, shard and slot.

    The rows are written once with their row number; only light rows are
    sorted, and the shards are joined back by the row number.
    """
    rows = written(docs.select(F.struct("*").alias("_row")).withColumn("rid", F.monotonically_increasing_id()),
                   "shard-rows")
    return rows.join(assign(_light(rows), n_shards).drop("doc_id"), "rid").drop("rid")


def op3_sharding(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.struct("doc_id", "text").alias("_row"))
    light = written(_light(docs.withColumn("rid", F.monotonically_increasing_id())), "shard-input")
    return assign(light).select("doc_id", "size", F.col("crc").alias("text_crc32"), F.lit(LAW).alias("law"),
                                "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
