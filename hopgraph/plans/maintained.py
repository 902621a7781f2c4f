"""Two-hop rankings kept up to date by signed changes.

A ranking is the multiset of edges one hop beyond the base set, counted per
(handle, did, display_name): ``links`` edges, the newest of them in ``last``.
The literal views (M7-M10) are its rows, the popularity views (M12) its sums
per (handle, did); what the base actor follows is taken out on reading, so a
change of it costs nothing.

When a batch is upserted, the ranking changes by

    (E' - E) join B'   +   E join (B' - B)

with E, E' the edges and B, B' the base set before and after: the batch's
rows (+1), the stored rows that they replace (-1), and the stored edges of
accounts that entered (+1) or left (-1) the base set.  Counts add up; the
newest edge is looked up again only where one was taken away.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hopgraph.operators.aggregate import popularity_order
from hopgraph.operators.joins import not_in, restrict_actor
from hopgraph.schemas import EDGE_KEY

CANDIDATE = ["handle", "did", "display_name"]
LAST = ["_dlt_load_time", "_dlt_id"]
HOP = [*CANDIDATE, "actor", *LAST]


def ranking_of(edges: DataFrame, base: DataFrame) -> DataFrame:
    """(``handle``, ``did``, ``display_name``, ``links``, ``last``) from scratch."""
    hop = restrict_actor(edges, base)
    return hop.groupBy(*CANDIDATE).agg(F.count(F.lit(1)).alias("links"), F.max(F.struct(*LAST)).alias("last"))


def edge_changes(before: DataFrame, batch: DataFrame, keys: Sequence[str] = EDGE_KEY) -> DataFrame:
    """Signed rows of a last-batch-wins upsert: what it replaces (-1) and what it brings (+1)."""
    gone = before.join(batch.select(*keys).distinct(), list(keys), "left_semi")
    return (gone.select(*HOP, F.lit(-1).cast("long").alias("sign"))
            .unionByName(batch.select(*HOP, F.lit(1).cast("long").alias("sign"))))


def hop_changes(changes: DataFrame, before: DataFrame, base_before: DataFrame, base_after: DataFrame) -> DataFrame:
    """Signed rows of the ranking's multiset; ``base_*`` hold distinct handles."""
    came = base_after.join(base_before, "handle", "left_anti")
    left = base_before.join(base_after, "handle", "left_anti")
    stored = before.select(*HOP)
    return (restrict_actor(changes, base_after)
            .unionByName(restrict_actor(stored, came).withColumn("sign", F.lit(1).cast("long")))
            .unionByName(restrict_actor(stored, left).withColumn("sign", F.lit(-1).cast("long"))))


def _same(a: str, b: str):
    cond = F.col(f"{a}.{CANDIDATE[0]}").eqNullSafe(F.col(f"{b}.{CANDIDATE[0]}"))
    for c in CANDIDATE[1:]:
        cond = cond & F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
    return cond


def apply_changes(ranking: DataFrame, hop: DataFrame, after: DataFrame, base_after: DataFrame) -> DataFrame:
    """The ranking after the signed changes ``hop``; ``after`` are the edges after the upsert."""
    delta = hop.groupBy(*CANDIDATE).agg(
        F.sum("sign").alias("links"), F.max(F.when(F.col("sign") > 0, F.struct(*LAST))).alias("last"),
        F.max(F.col("sign") < 0).alias("lost"))
    key = [F.coalesce(f"r.{c}", f"d.{c}").alias(c) for c in CANDIDATE]
    summed = ranking.alias("r").join(delta.alias("d"), _same("r", "d"), "full_outer").select(
        *key, (F.coalesce("r.links", F.lit(0)) + F.coalesce("d.links", F.lit(0))).alias("links"),
        F.greatest("r.last", "d.last").alias("last"), F.coalesce("d.lost", F.lit(False)).alias("lost")).where("links > 0")
    # where an edge was taken away, the newest of those that are left
    lost = delta.where("lost").select("handle").distinct().withColumnRenamed("handle", "_h")
    again = after.join(lost, F.col("handle").eqNullSafe(F.col("_h")), "left_semi")
    looked = ranking_of(again, base_after).drop("links")
    return summed.alias("s").join(looked.alias("n"), _same("s", "n"), "left").select(
        *[F.col(f"s.{c}") for c in CANDIDATE], "s.links",
        F.when(F.col("s.lost"), F.col("n.last")).otherwise(F.col("s.last")).alias("last"))


def literal(ranking: DataFrame, exclude: DataFrame) -> DataFrame:
    """M7-M10 from a ranking: ``follower_count`` is 1, as the reference's DISTINCT makes it."""
    rows = ranking.select(*CANDIDATE, F.lit(1).cast("long").alias("follower_count"))
    return popularity_order(not_in(rows, "handle", exclude, "handle"))


def popularity(ranking: DataFrame, exclude: DataFrame) -> DataFrame:
    """M12 from a ranking: links per (handle, did), under the newest display name."""
    summed = ranking.groupBy("handle", "did").agg(
        F.sum("links").alias("follower_count"), F.max(F.struct("last", "display_name")).alias("top"))
    kept = not_in(summed, "handle", exclude, "handle")
    return popularity_order(kept.select("handle", "did", F.col("top.display_name").alias("display_name"), "follower_count"))
