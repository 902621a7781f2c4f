"""Window operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order_col: str,
                   tiebreak: Sequence[str] = ()) -> DataFrame:
    """Keep the newest row per key (ROW_NUMBER() ... = 1).

    Ties on ``order_col`` fall to ``tiebreak`` (descending) so the result is
    deterministic.  Spark plans this as a partial WindowGroupLimit before the
    shuffle, so a key repeated across many rows ships at most one row per map
    task.
    """
    order = [F.col(order_col).desc_nulls_last()] + [F.col(c).desc_nulls_last() for c in tiebreak]
    w = Window.partitionBy(*keys).orderBy(*order)
    cols = df.columns
    return df.select(*cols, F.row_number().over(w).alias("_rn")).where(F.col("_rn") == 1).select(*cols)
