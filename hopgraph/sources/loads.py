"""Load bookkeeping: append a batch as one load (I4) and record it in the ledger.

A load's files lie in a partition of their own, and the ledger entry comes
last.  A run that stops in between leaves files without an entry: readers that
go through ``finished_loads`` do not see them, and the retry overwrites them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hopgraph.functions.scalar import epoch_seconds_to_ts
from hopgraph.operators.projection import ts_literal, typed_projection
from hopgraph.schemas import LOAD_DATE, LOAD_PART, LOADS


def row_id(columns: Sequence[str | Column]) -> Column:
    """Deterministic row id: sha-256 over the load id and key columns.

    Stable across task retries, unlike a random id.  The fields are hashed as
    one JSON object, so NULLs keep their place and no separator can be forged.
    """
    cols = [(F.col(c) if isinstance(c, str) else c).alias(f"c{i}") for i, c in enumerate(columns)]
    return F.sha2(F.to_json(F.struct(*cols)), 256)


def load_date(load_id: str | Column = "_dlt_load_id") -> Column:
    """The day of a load, from the same expression as its load time (F1)."""
    return F.to_date(epoch_seconds_to_ts(load_id)).alias(LOAD_DATE)


def loads_between(landed: DataFrame, start, end) -> DataFrame:
    """Rows of the loads whose day touches [start, end], without the day column.

    For tables that ``append_load`` (or another writer using ``load_date``)
    partitioned by ``LOAD_DATE``: the days become a partition filter.  The
    exact load-time range still has to follow.
    """
    day = lambda x: ts_literal(x).cast("date")
    return landed.where(F.col(LOAD_DATE).between(day(start), day(end))).drop(LOAD_DATE)


def load_part(load_id: Column) -> Column:
    return F.concat(F.lit("load-"), load_id).alias(LOAD_PART)


def finished_loads(landed: DataFrame, ledger: DataFrame) -> DataFrame:
    """Rows of the loads that the ledger lists as finished (status 0), without the load partition.

    A semi-join on the partition column, so unfinished loads are pruned, not read.
    """
    done = ledger.where(F.col("status") == 0).select(load_part(F.col("load_id"))).distinct()
    return landed.join(done, LOAD_PART, "left_semi").drop(LOAD_PART)


def schema_hash(df: DataFrame) -> str:
    return hashlib.sha256(df.schema.json().encode()).hexdigest()


def append_load(df: DataFrame, path: str, load_id: str | Column, id_columns: Sequence[str],
                ledger_path: str | None = None, schema_name: str = "graph_crawl",
                inserted_at: Column | None = None) -> DataFrame:
    """I4: append ``df`` as one load: ``_dlt_load_id`` plus a per-row ``_dlt_id``.

    ``load_id`` is epoch-seconds text, either a literal or a scalar Column
    (for example ``batch.select(...).scalar()``).  The files go to the load's
    own partition (its day, ``LOAD_DATE``, then the load, ``LOAD_PART``), which
    is overwritten: a retry replaces what a stopped run left.  With
    ``ledger_path`` the load is recorded there afterwards (I5), and a load that
    the ledger already lists is not written again.  A load id that is no number
    fails before anything is written.  Returns the load's rows.
    """
    lid = F.lit(load_id) if isinstance(load_id, str) else load_id
    out = (df.withColumn("_dlt_load_id", lid)
             .withColumn("_dlt_id", row_id(["_dlt_load_id", *id_columns])))
    spark = df.sparkSession
    if ledger_path is not None and _listed(spark, ledger_path, lid):
        return out
    (out.select("*", load_date(), load_part(F.col("_dlt_load_id")))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(LOAD_DATE, LOAD_PART).parquet(path))
    if ledger_path is not None:
        entry = spark.range(1).select(
            lid.alias("load_id"), F.lit(schema_name).alias("schema_name"),
            F.lit(0).cast("bigint").alias("status"),
            (inserted_at if inserted_at is not None else F.current_timestamp()).alias("inserted_at"),
            F.lit(schema_hash(out)).alias("schema_version_hash"))
        loads_ledger(entry, ledger_path)
    return out


def _listed(spark: SparkSession, ledger_path: str, load_id: Column) -> bool:
    """Whether the ledger already has an entry of this load."""
    try:
        ledger = spark.read.schema(LOADS).parquet(ledger_path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return not ledger.where(F.col("load_id") == load_id).isEmpty()


def loads_ledger(entries: DataFrame, path: str) -> None:
    """Append ledger rows (load_id, schema_name, status, inserted_at, schema_version_hash)."""
    typed_projection(entries, LOADS).write.mode("append").parquet(path)
