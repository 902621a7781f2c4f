"""Edges as keyed stream state.

The newest row of every (handle, actor) lives in Spark's state store; each
micro-batch emits the keys that it changed.  What was emitted is a change
log, from which the table is read or brought up to date.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StructField, StructType

from hopgraph.operators.projection import in_range
from hopgraph.plans.edges import typed_edges
from hopgraph.schemas import EDGE, EDGE_COLUMNS, EDGE_KEY, RAW_EDGE
from hopgraph.session import pin_session

LOG = StructType(EDGE.fields + [StructField("batch_id", IntegerType(), True)])


def newest_edges(raw: DataFrame, start, end) -> DataFrame:
    """M1 / M2 as an aggregate: the newest row per (handle, actor), by load time, then row id.

    The same rows as the window form.  On a stream the aggregate's buffer is
    the keyed state.
    """
    typed = in_range(typed_edges(raw), "_dlt_load_time", start, end)
    rest = [c for c in EDGE_COLUMNS if c not in EDGE_KEY]
    newest = typed.groupBy(*EDGE_KEY).agg(
        F.max_by(F.struct(*rest), F.struct("_dlt_load_time", "_dlt_id")).alias("_row"))
    return newest.select(*EDGE_KEY, "_row.*").select(*EDGE_COLUMNS)


def edges_stream(spark: SparkSession, source: str, target: str, checkpoint: str, start, end,
                 available_now: bool = True, max_files_per_trigger: int | None = None,
                 schema: StructType = RAW_EDGE, condition: Column | None = None) -> StreamingQuery:
    """Raw edge files -> newest row per key in the state store -> changed keys to ``target``.

    Update mode: a micro-batch writes only the keys it touched, to its own
    ``batch_id=N`` folder (overwritten when the batch is replayed).  Files may
    arrive in any order: the state keeps the newest row.  A restart from the
    checkpoint goes on with the state it left.
    """
    pin_session(spark)
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.parquet(source)
    if condition is not None:
        raw = raw.where(condition)

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")

    writer = (newest_edges(raw, start, end).writeStream.outputMode("update").foreachBatch(sink)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def edges_of_log(spark: SparkSession, target: str, after_batch: int = -1) -> DataFrame:
    """The edges that the log holds: each key's last change after ``after_batch``.

    One aggregate; partial before its shuffle, so a key that changes in every
    micro-batch ships one row per map task.
    """
    log = spark.read.schema(LOG).parquet(target).where(F.col("batch_id") > after_batch)
    rest = [c for c in EDGE_COLUMNS if c not in EDGE_KEY]
    last = log.groupBy(*EDGE_KEY).agg(F.max_by(F.struct(*rest), "batch_id").alias("_row"))
    return last.select(*EDGE_KEY, "_row.*").select(*EDGE_COLUMNS)
