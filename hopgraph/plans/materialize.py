"""Materialisation kinds (K1-K5).

The row logic of upserts and interval reloads is plain DataFrame transforms
over (stored rows, batch); the caller writes what they return.
``HourlyTable`` applies interval reloads to the hours they cover;
``hopgraph.plans.stored`` upserts into tables bucketed by key.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hopgraph.functions.scalar import as_datetime
from hopgraph.operators.projection import ts_literal
from hopgraph.session import scratch_root


def upsert_by_key(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """K1: ``target`` with the batch rows in place of rows of the same key (last batch wins).

    Nothing compares with stored rows beyond the key, so re-running an old
    interval puts old rows back, as the reference does.  NULL keys never
    match.
    """
    kept = target.join(batch.select(*keys).distinct(), list(keys), "left_anti")
    return kept.select(*target.columns).unionByName(batch.select(*target.columns))


def upsert_newest(target: DataFrame, batch: DataFrame, keys: Sequence[str], order_col: str) -> DataFrame:
    """Upsert where a stored row survives when it is newer than the batch row.

    For micro-batches whose files may arrive out of time order.
    """
    stored = target.select(*keys, F.col(order_col).alias("_stored_t"))
    stale = (batch.join(stored, list(keys))
                  .where(F.col("_stored_t") > F.col(order_col)).select(*keys))
    return upsert_by_key(target, batch.join(stale, list(keys), "left_anti"), keys)


def overwrite_interval(target: DataFrame, batch: DataFrame, time_col: str, start, end) -> DataFrame:
    """K2: ``target`` with the rows of one time interval [start, end] replaced by ``batch``'s.

    Stored rows outside the interval (or with a NULL time) are kept; batch
    rows outside it are ignored.  An interval the batch leaves empty is
    emptied.
    """
    inside = F.col(time_col).between(ts_literal(start), ts_literal(end))
    return target.where(~inside | F.col(time_col).isNull()).unionByName(batch.where(inside))


def view_model(df: DataFrame, name: str) -> DataFrame:
    """K3: a view, recomputed on every read."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


class HourlyTable:
    """Interval reloads that touch only the hours they cover (K2 / K5 at scale).

    A managed catalog table partitioned by ``(_day, _hour)`` of a time
    column, in a database located in the shared scratch folder.  ``reload``
    widens the interval to whole hours, clips the batch to them, overwrites
    the hours that the batch holds (dynamic partition overwrite) and only then
    drops the interval's hours that it leaves empty.  Work and rewritten data
    are proportional to the interval, not the table, and a failed write leaves
    the stored hours in place.

    Widening to whole hours recomputes the rows of the partial first / last
    hour from the source; for a pure projection of the source (such as M11)
    that equals keeping them.
    """

    PARTS = ["_day", "_hour"]

    def __init__(self, spark: SparkSession, name: str, time_col: str, database: str = "hopgraph_tables"):
        self.spark, self.time_col = spark, time_col
        self.qualified = f"{database}.{name}"
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{scratch_root(spark)}/warehouse'")

    @staticmethod
    def hour_bounds(start, end) -> tuple[dt.datetime, dt.datetime]:
        lo = as_datetime(start).replace(minute=0, second=0, microsecond=0)
        hi = as_datetime(end).replace(minute=59, second=59, microsecond=999999)
        return lo, hi

    def _with_parts(self, df: DataFrame) -> DataFrame:
        t = F.col(self.time_col)
        return df.withColumn("_day", F.to_date(t)).withColumn("_hour", F.hour(t))

    def _partitions(self) -> list[tuple[dt.date, int]]:
        """The table's catalog partitions (metadata only, 24 per stored day), listed once."""
        out = []
        for (spec,) in self.spark.sql(f"SHOW PARTITIONS {self.qualified}").collect():
            kv = dict(p.split("=", 1) for p in spec.split("/"))
            out.append((dt.date.fromisoformat(kv["_day"]), int(kv["_hour"])))
        return out

    def reload(self, build, start, end) -> None:
        """Replace the hours of [start, end] with ``build(lo, hi)``'s rows."""
        lo, hi = self.hour_bounds(start, end)
        batch = self._with_parts(build(lo, hi).where(
            F.col(self.time_col).between(ts_literal(lo), ts_literal(hi))))
        self._replace(batch, lambda hour: lo <= hour <= hi)

    def reload_hours(self, build, hours: Sequence[dt.datetime]) -> None:
        """Replace single hours, in one job, with their rows of ``build(lo, hi)`` over the span of them all."""
        wanted = {self.hour_bounds(h, h)[0] for h in hours}
        if not wanted:
            return
        parts = self.spark.createDataFrame([(h.date(), h.hour) for h in sorted(wanted)], "_day date, _hour int")
        rows = self._with_parts(build(*self.hour_bounds(min(wanted), max(wanted))))
        self._replace(rows.join(parts, self.PARTS, "left_semi").select(*rows.columns), wanted.__contains__)

    def _replace(self, batch: DataFrame, covers: Callable[[dt.datetime], bool]) -> None:
        """Overwrite the hours that ``batch`` holds, then drop the other hours that ``covers`` names."""
        if not self.spark.catalog.tableExists(self.qualified):
            batch.limit(0).write.format("parquet").partitionBy(*self.PARTS).saveAsTable(self.qualified)
        inside = [(d, h) for d, h in self._partitions() if covers(dt.datetime.combine(d, dt.time(h)))]
        run = uuid.uuid4().hex
        columns = self.spark.table(self.qualified).columns
        staged = f"{scratch_root(self.spark)}/hourly_batches/{run}"
        batch.select(*columns).write.parquet(staged)          # the batch is computed once
        batch = self.spark.read.schema(batch.select(*columns).schema).parquet(staged)
        filled = {(r["_day"], r["_hour"]) for r in batch.select(*self.PARTS).distinct().collect()}   # hours
        mode = "spark.sql.sources.partitionOverwriteMode"
        before = self.spark.conf.get(mode)
        self.spark.conf.set(mode, "dynamic")       # insertInto takes it from the session only
        try:
            batch.write.insertInto(self.qualified, overwrite=True)
        finally:
            self.spark.conf.set(mode, before)
        empty = [x for x in inside if x not in filled]
        if empty:
            specs = ", ".join(f"PARTITION (_day = DATE'{d.isoformat()}', _hour = {h})" for d, h in empty)
            self.spark.sql(f"ALTER TABLE {self.qualified} DROP IF EXISTS {specs}")

    def read(self) -> DataFrame:
        return self.spark.table(self.qualified).drop(*self.PARTS)
