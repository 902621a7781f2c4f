"""Stored edge tables and the upsert that keeps them (K1 with co-located keys).

A stored table is a catalog table written with ``bucketBy`` on its key, so a
batch joins it bucket by bucket: only the batch is shuffled, to the table's
own bucket count, and every task writes the bucket that it read.  The result
is a new table; ``publish`` points a view at it once it is whole, which is
what readers use.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hopgraph.session import pin_session, scratch_root

DATABASE = "hopgraph_tables"
BUCKETS = 64


def qualified(spark: SparkSession, name: str) -> str:
    """``name`` in the library's database, which lies in the shared scratch folder."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {DATABASE} LOCATION '{scratch_root(spark)}/warehouse'")
    return f"{DATABASE}.{name}"


def unique_or_fail(rows: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """A3 as part of the write: ``rows`` dealt by key into ``buckets``, failing on a key seen twice.

    The check is an expression over the rows' own window, so it runs in the
    job that writes them, without a second scan.  Keys with a NULL are not checked.
    """
    dealt = rows.repartition(buckets, *keys)
    known: Column = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    times = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    text = F.concat(F.lit("key is not unique: "), F.to_json(F.struct(*keys)))
    checked = F.when(known & (times > 1), F.raise_error(text).cast("boolean")).otherwise(F.lit(True))
    return dealt.withColumn("_unique", checked)


def store(rows: DataFrame, name: str, keys: Sequence[str], buckets: int = BUCKETS,
          sort: Sequence[str] = ()) -> DataFrame:
    """``rows`` (unique by ``keys``) as a bucketed table, each bucket sorted by ``sort`` (or the keys).

    Sorting by another column lets Parquet's statistics skip row groups for filters on it.
    """
    spark = rows.sparkSession
    pin_session(spark)
    table = qualified(spark, name)
    checked = unique_or_fail(rows, keys, buckets).where("_unique").select(*rows.columns)
    checked.write.format("parquet").bucketBy(buckets, *keys).sortBy(*(sort or keys)).saveAsTable(table)
    return spark.table(table)


def merged(target: DataFrame, batch: DataFrame, keys: Sequence[str], buckets: int,
           newest: Sequence[str] = ()) -> DataFrame:
    """K1's rows: ``target`` with the batch's rows in place of rows of the same key.

    One outer join over the key.  With ``newest`` a stored row stays when it
    is the greater by those columns (for batches that may arrive out of
    order).  NULL keys never match.
    """
    new = unique_or_fail(batch.select(*target.columns), keys, buckets)
    new = new.select(*[F.col(c).alias(f"_new_{c}") for c in target.columns], F.col("_unique").alias("_new"))
    same: Column = F.lit(True)
    for k in keys:
        same = same & (F.col(k) == F.col(f"_new_{k}"))
    take = F.coalesce("_new", F.lit(False))
    if newest:
        here = F.struct(*newest)
        there = F.struct(*[F.col(f"_new_{c}") for c in newest])
        matched = F.col(keys[0]).isNotNull()
        take = take & ~(matched & (here > there))
    return target.join(new, same, "full_outer").select(
        *[F.when(take, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) for c in target.columns])


def upsert(name: str, batch: DataFrame, keys: Sequence[str], into: str, buckets: int = BUCKETS,
           newest: Sequence[str] = (), sort: Sequence[str] = ()) -> DataFrame:
    """K1 over a stored table: the table ``into`` holds ``name`` with ``batch`` applied.

    Last batch wins, or the newest row by the columns ``newest``.  A repeated
    key in the batch fails the write, and ``into`` is not published.
    """
    spark = batch.sparkSession
    pin_session(spark)
    rows = merged(spark.table(qualified(spark, name)), batch, keys, buckets, newest)
    (rows.write.format("parquet").bucketBy(buckets, *keys).sortBy(*(sort or keys))
     .saveAsTable(qualified(spark, into)))
    return spark.table(qualified(spark, into))


def publish(spark: SparkSession, view: str, name: str) -> DataFrame:
    """Point the view that readers use at a finished table."""
    spark.sql(f"CREATE OR REPLACE VIEW {qualified(spark, view)} AS SELECT * FROM {qualified(spark, name)}")
    return spark.table(qualified(spark, view))
