"""Event projection over a file stream (T1), and hours closed by a watermark (K5)."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hopgraph.functions.scalar import as_datetime
from hopgraph.plans.events import jetstream_events
from hopgraph.plans.materialize import HourlyTable
from hopgraph.schemas import JETSTREAM
from hopgraph.session import pin_session


def _has_files(spark: SparkSession, path: str) -> bool:
    try:
        return bool(spark.read.text(path).inputFiles())
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return False


def jetstream_stream(spark: SparkSession, source: str, target: str, checkpoint: str, start, end,
                     strip_json_quotes: bool = False, available_now: bool = True,
                     max_files_per_trigger: int | None = None) -> StreamingQuery:
    """M11's projection applied to every new file under ``source``.

    The same transform as batch M11.  Each micro-batch is written through
    ``foreachBatch`` to its own ``batch_id=N`` folder under ``target`` with
    overwrite, so a batch replayed after a failure replaces its earlier
    attempt instead of duplicating it; the checkpoint in the shared folder
    makes restarts resume where they stopped.  Read ``target`` back as one
    table (``batch_id`` appears as a partition column).  Batch numbers belong
    to their checkpoint, so a new checkpoint with a filled target is refused.
    """
    if _has_files(spark, target) and not _has_files(spark, f"{checkpoint}/metadata"):
        raise ValueError(f"{target} holds batches of another checkpoint than {checkpoint}")
    reader = spark.readStream.schema(JETSTREAM)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    events = jetstream_events(reader.parquet(source), start, end, strip_json_quotes)

    def sink(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")

    writer = events.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def hour_counts(events: DataFrame, delay: str) -> DataFrame:
    """(``hour``, ``n_events``) under a watermark of ``delay`` behind the newest event.

    On a stream the state holds the hours that are still open: in update mode
    a micro-batch gives the hours it touched, in append mode each hour comes
    once, when the watermark has passed its end.  Events of closed hours are
    dropped.
    """
    timed = events.withColumn("_t", F.col("ts").cast("timestamp")).withWatermark("_t", delay)
    return (timed.groupBy(F.window("_t", "1 hour")).agg(F.count("*").alias("n_events"))
            .select(F.col("window.start").cast("timestamp_ntz").alias("hour"), "n_events"))


def _new_events(spark: SparkSession, source: str, start, end, max_files_per_trigger: int | None) -> DataFrame:
    pin_session(spark)
    reader = spark.readStream.schema(JETSTREAM)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return jetstream_events(reader.parquet(source), start, end)


def hourly_stream(spark: SparkSession, source: str, table: HourlyTable, checkpoint: str, start, end, delay: str,
                  available_now: bool = True, max_files_per_trigger: int | None = None,
                  strip_json_quotes: bool = False, derived_days: bool = False) -> StreamingQuery:
    """K5 on event time: hours of ``table`` follow the files under ``source`` until a watermark closes them.

    A micro-batch reloads from the source only the hours that its events fall
    in: new ones, and earlier ones that late events within ``delay`` reach.
    A reload replaces the hour, so a replayed batch changes nothing.  An event
    later than the watermark reloads nothing: its hour stays as it was closed.
    The driver receives the touched hours, no rows.
    """
    def build(lo, hi) -> DataFrame:
        landed = spark.read.schema(JETSTREAM).parquet(source)
        return jetstream_events(landed, max(lo, as_datetime(start)), min(hi, as_datetime(end)),
                                strip_json_quotes, derived_days)

    def sink(batch: DataFrame, batch_id: int) -> None:
        table.reload_hours(build, [r["hour"] for r in batch.select("hour").collect()])

    touched = hour_counts(_new_events(spark, source, start, end, max_files_per_trigger), delay)
    writer = touched.writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def closed_hours_stream(spark: SparkSession, source: str, target: str, checkpoint: str, start, end, delay: str,
                        available_now: bool = True, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """The ledger of closed hours: (``hour``, ``n_events``), each hour once, when no event can reach it any more."""
    closed = hour_counts(_new_events(spark, source, start, end, max_files_per_trigger), delay)
    writer = (closed.writeStream.outputMode("append").format("parquet").option("path", target)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
