"""Joins (J1, J2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def restrict_actor(edges: DataFrame, keys: DataFrame, key_col: str = "handle", edge_col: str = "actor") -> DataFrame:
    """Edges whose actor is among ``keys``: a lazy semi-join.

    Spark broadcasts the keys by their bytes, or shuffles both sides and
    splits a skewed actor.
    """
    k = keys.select(F.col(key_col).alias("_base_key"))
    return edges.join(k, F.col(edge_col) == F.col("_base_key"), "left_semi")


def edge_join(edges: DataFrame, base: DataFrame, base_col: str = "handle",
              edge_col: str = "actor", how: str = "inner") -> DataFrame:
    """``edges JOIN base ON edges.actor = base.handle``.

    Returns the edge columns only.  Whether ``base`` is broadcast is decided
    by Spark (its bytes) or by AQE.
    """
    b = base.select(F.col(base_col).alias("_base_key"))
    out = edges.join(b, F.col(edge_col) == F.col("_base_key"), how)
    return out.drop("_base_key") if how in ("inner", "left", "left_outer") else out


def not_in(df: DataFrame, column: str, exclude: DataFrame, exclude_col: str = "handle") -> DataFrame:
    """``WHERE NOT column IN (SELECT exclude_col FROM exclude)``, null-aware.

    SQL NOT IN keeps a row only when the set is empty, or the value is not
    NULL, not in the set, and the set holds no NULL.

    The empty / NULL guards are one scalar subquery over the set, evaluated
    when the query runs, and Spark picks the anti join by its statistics.
    There is no forced broadcast: Spark's own NOT IN rewrite always
    broadcasts the set, whatever its size.
    """
    ex = exclude.select(F.col(exclude_col).alias("_ex_key"))
    kind = F.when(F.count(F.lit(1)) == 0, "empty").when(F.count_if(F.col("_ex_key").isNull()) > 0, "null").otherwise("plain")
    guard = ex.select(kind).scalar()
    kept = df.join(ex, F.col(column) == F.col("_ex_key"), "left_anti")
    return kept.where((guard == "empty") | (F.col(column).isNotNull() & (guard == "plain")))
