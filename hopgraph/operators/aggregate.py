"""Aggregation and ordering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A1: SELECT DISTINCT over ``columns`` (NULLs compare equal)."""
    return df.select(*columns).distinct()


def group_count(df: DataFrame, keys: Sequence[str], name: str = "follower_count") -> DataFrame:
    """A2: COUNT(*) grouped by ``keys`` (partial aggregation before the shuffle)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def audit_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A3: key tuples seen more than once; an empty result means the audit passes."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
              .where(F.col("n_rows") > 1))


def popularity_order(df: DataFrame, count_col: str = "follower_count",
                     tiebreak: Sequence[str] = ("handle", "did", "display_name")) -> DataFrame:
    """O1: ORDER BY count DESC, with a tiebreak so the order is deterministic."""
    present = [c for c in tiebreak if c in df.columns]
    return df.orderBy(F.col(count_col).desc(), *[F.col(c).asc_nulls_first() for c in present])


def crawl_summary(outcomes: DataFrame) -> DataFrame:
    """Processed / successful / failed counts and durations of a crawl."""
    return outcomes.agg(
        F.count(F.lit(1)).alias("processed"),
        F.count_if(F.col("success")).alias("successful"),
        F.count_if(~F.col("success")).alias("failed"),
        F.count_distinct("actor").alias("actors"),
        F.round(F.sum("duration_s"), 6).alias("total_duration_s"),
        F.round(F.avg("duration_s"), 6).alias("avg_duration_s"),
    )
