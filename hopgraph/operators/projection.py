"""Projections, filters and predicates."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from hopgraph.functions.scalar import as_datetime

SENTINEL_HANDLE = "handle.invalid"


def typed_projection(df: DataFrame, types: StructType | Mapping[str, DataType | str]) -> DataFrame:
    """Project and cast each column to its declared type, in declared order."""
    pairs = ([(f.name, f.dataType) for f in types.fields] if isinstance(types, StructType)
             else list(types.items()))
    return df.select(*[F.col(n).cast(t).alias(n) for n, t in pairs])


def column_subset(df: DataFrame, columns: Iterable[str] | Mapping[str, str]) -> DataFrame:
    """Narrow to named columns; a mapping renames ``{source: alias}``."""
    if isinstance(columns, Mapping):
        return df.select(*[F.col(s).alias(a) for s, a in columns.items()])
    return df.select(*columns)


def actor_filter(df: DataFrame, actor: str, column: str = "actor") -> DataFrame:
    """``actor = @base_actor`` (a literal, so it reaches the Parquet scan)."""
    return df.where(F.col(column) == F.lit(actor))


def ts_literal(x: dt.datetime | dt.date | str) -> Column:
    """A naive timestamp literal; a date means midnight."""
    return F.lit(as_datetime(x)).cast("timestamp_ntz")


def in_range(df: DataFrame, column: str | Column, start, end) -> DataFrame:
    """Inclusive ``column BETWEEN start AND end`` on naive timestamps.

    A date bound means midnight of that day (use ``day_bounds`` for whole days).
    """
    c = F.col(column) if isinstance(column, str) else column
    return df.where(c.between(ts_literal(start), ts_literal(end)))


def sentinel_filter(df: DataFrame, column: str = "handle", sentinel: str = SENTINEL_HANDLE) -> DataFrame:
    """P5: drop placeholder accounts (``handle.invalid``); a NULL handle is no placeholder and stays."""
    return df.where(~F.col(column).eqNullSafe(F.lit(sentinel)))


def with_aliases(df: DataFrame, steps: Iterable[tuple[str, Callable[[], Column] | Column]]) -> DataFrame:
    """Select aliases that later expressions (and WHERE / window ORDER BY) reuse.

    Each step adds one named column, so later steps may refer to earlier names.
    """
    for name, expr in steps:
        df = df.withColumn(name, expr() if callable(expr) else expr)
    return df


def struct_field(path: str, alias: str | None = None) -> Column:
    """Struct field access ``commit.collection`` named by its last part."""
    return F.col(path).alias(alias or path.rsplit(".", 1)[-1])
