"""Completeness of landed crawls: the chain of page cursors.

A crawl asks for a first page without a cursor and for every further page
with the cursor that the page before returned; the last returns none.  A
request that failed leaves a hole in this chain, and the crawl looks finished.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hopgraph.session import written

COMPLETE, BROKEN, CYCLIC, NO_START = "complete", "broken", "cyclic", "no first page"


def cursor_chains(pages: DataFrame, keys: Sequence[str] = ("actor",)) -> DataFrame:
    """One row per crawl: ``pages`` landed, ``reached`` from the first page, ``state``, ``gap``.

    ``pages`` has the crawl's ``keys``, the cursor that a page was asked with
    (``cursor``; NULL or empty: the first page) and the one it returned
    (``next_cursor``; NULL or empty: the last).  ``gap`` is the cursor whose page
    is missing.  A page landed twice counts once.

    Pointer jumping: every page first points to its successor, and in each
    round to the page that its target points to, so a chain of n pages is
    followed to its end in log2(n) joins, each on (keys, cursor).  Pages that
    still point somewhere then run in a circle.
    """
    keys = list(keys)
    text = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    p = (pages.select(*keys, text("cursor"), text("next_cursor"))
         .groupBy(*keys, "cursor").agg(F.max("next_cursor").alias("to")))
    p = written(p.withColumn("steps", F.lit(1).cast("long")).withColumn("gap", F.lit(None).cast("string")),
                "cursor-chains")
    same = [f"_{k}" for k in keys]
    longest = p.groupBy(*keys).count().agg(F.max("count")).first()[0] or 1
    for _ in range(int(longest).bit_length() + 1):
        ahead = p.select(*[F.col(k).alias(s) for k, s in zip(keys, same, strict=True)], F.col("cursor").alias("_at"),
                         F.col("to").alias("_to"), F.col("steps").alias("_steps"), F.col("gap").alias("_gap"))
        meets = F.col("to") == F.col("_at")
        for k, s in zip(keys, same, strict=True):
            meets = meets & F.col(k).eqNullSafe(F.col(s))
        open_ = (F.col("to") != "") & F.col("gap").isNull()
        j = p.withColumn("_open", open_).join(ahead, meets & F.col("_open"), "left")
        found = F.col("_at").isNotNull()
        p = written(j.select(
            *keys, "cursor", F.when(found, F.col("_to")).otherwise(F.col("to")).alias("to"),
            F.when(found, F.col("steps") + F.col("_steps")).otherwise(F.col("steps")).alias("steps"),
            F.when(found, F.col("_gap")).when(F.col("_open"), F.col("to")).otherwise(F.col("gap")).alias("gap")),
            "cursor-chains")
    start = F.col("cursor") == ""
    per = p.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("pages"), F.max(F.when(start, F.struct("to", "steps", "gap"))).alias("first"))
    state = (F.when(F.col("first").isNull(), NO_START).when(F.col("first.gap").isNotNull(), BROKEN)
             .when(F.col("first.to") == "", COMPLETE).otherwise(CYCLIC))
    out = per.withColumn("state", state)
    return out.select(*keys, "pages", F.when(F.col("state") == NO_START, 0).when(F.col("state") != CYCLIC, F.col("first.steps"))
                      .cast("long").alias("reached"), "state", F.col("first.gap").alias("gap"))
