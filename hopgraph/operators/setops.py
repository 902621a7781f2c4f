"""Set operations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hopgraph.operators.projection import SENTINEL_HANDLE


def union_all(frames: Sequence[DataFrame], columns: Sequence[str]) -> DataFrame:
    """UNION ALL of ``columns`` from each frame, matched by name."""
    return reduce(lambda a, b: a.unionByName(b), [f.select(*columns) for f in frames])


def crawl_frontier(followers: DataFrame, follows: DataFrame, base_actor: str,
                   drop_invalid: bool = True, include_base: bool = True) -> DataFrame:
    """Distinct handles one hop from the base actor: the next crawl's work list.

    ``drop_invalid`` removes the ``handle.invalid`` placeholder; ``include_base``
    adds the base actor itself.
    """
    adjacent = union_all([followers.where(F.col("actor") == base_actor),
                          follows.where(F.col("actor") == base_actor)], ["handle"])
    if drop_invalid:
        adjacent = adjacent.where(~F.col("handle").eqNullSafe(F.lit(SENTINEL_HANDLE)))
    if include_base:
        base = followers.sparkSession.range(1).select(F.lit(base_actor).alias("handle"))
        adjacent = adjacent.unionByName(base)
    return adjacent.distinct()
