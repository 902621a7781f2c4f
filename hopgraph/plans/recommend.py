"""Two-hop recommendations: M7-M10 and the intended popularity count M12.

All four reference views share one shape: take the accounts next to the base
actor (``base``), follow one more hop along an edge table, drop accounts the
base actor already follows (``exclude``, SQL NOT IN), then DISTINCT + COUNT.
Because of that DISTINCT, ``follower_count`` is always 1; the literal result
is kept, and ``popularity_ranked`` gives the count the views intend.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hopgraph.operators.aggregate import distinct_rows, group_count, popularity_order
from hopgraph.operators.joins import edge_join, not_in, restrict_actor
from hopgraph.operators.projection import actor_filter, in_range
from hopgraph.plans.edges import incremental_edges, typed_edges

VARIANTS = {
    # name: (candidate edge table, base set, excluded set)
    "followers_of_followers": ("followers", "followers", "follows"),
    "followers_of_follows": ("followers", "follows", "follows"),
    "follows_of_followers": ("follows", "followers", "follows"),
    "follows_of_follows": ("follows", "follows", "follows"),
}


def _hop(edges: DataFrame, base: DataFrame | None) -> DataFrame:
    """Edges whose actor is a base handle (``base=None``: already restricted).

    Base handles are de-duplicated first, which turns the inner join into a
    semi-join; that leaves the result unchanged because the rows are
    de-duplicated (or counted distinctly) right after.
    """
    if base is None:
        return edges
    return edge_join(edges, base.select("handle").distinct())


def two_hop(edges: DataFrame, base: DataFrame | None, exclude: DataFrame) -> DataFrame:
    """M7-M10 core: edges whose actor is a base handle, minus excluded handles.

    ``base`` and ``exclude`` are frames with a ``handle`` column; ``base=None``
    when ``edges`` were already restricted to the base handles (as
    ``incremental_edges(..., actors=...)`` does).

    NOT IN runs after the DISTINCT (it filters a grouping column, so the two
    commute): a hot handle is first collapsed by the map-side partial
    aggregate, and only distinct rows are shuffled by handle.
    """
    keys = ["handle", "did", "display_name"]           # in one order: one exchange serves DISTINCT and COUNT
    distinct = distinct_rows(_hop(edges, base), keys)
    kept = not_in(distinct, "handle", exclude, "handle")
    counted = group_count(kept, keys)
    return popularity_order(counted.select("handle", "did", "display_name", "follower_count"))


def popularity(edges: DataFrame, base: DataFrame | None, exclude: DataFrame) -> DataFrame:
    """M12 core: per (handle, did), how many distinct base-side accounts link to it.

    ``edges`` hold one row per (handle, actor), as ``incremental_edges``
    returns them, so counting rows per (handle, did) counts distinct actors.
    The display name is the newest one (by load time, then row id).  The
    aggregate is partial before its shuffle, so a popular handle ships one
    row per map task; NOT IN then filters the aggregated rows (it filters a
    grouping column, so the two commute).
    """
    newest = F.struct("_dlt_load_time", "_dlt_id", "display_name")
    per_handle = _hop(edges, base).groupBy("handle", "did").agg(
        F.count(F.lit(1)).alias("follower_count"), F.max(newest).alias("newest"))
    kept = not_in(per_handle, "handle", exclude, "handle")
    return popularity_order(kept.select(
        "handle", "did", F.col("newest.display_name").alias("display_name"), "follower_count"))


def neighbour_handles(raw: DataFrame, base_actor: str, start, end) -> DataFrame:
    """Handles next to the base actor: the handle column of M4 / M5.

    Latest-per-(handle, actor) keeps exactly one row for every key present,
    so the set of handles is the same before and after it; no window needed.
    """
    typed = in_range(actor_filter(typed_edges(raw), base_actor), "_dlt_load_time", start, end)
    return typed.select("handle")


def _model(core, raw: dict[str, DataFrame], variant: str, base_actor: str, start, end) -> DataFrame:
    """One lazy plan: nothing is measured or fetched while it is built.

    The candidates are restricted to the base handles by a semi-join before
    the latest-per-key window (``actor`` is one of its keys), so only the
    neighbourhood is shuffled; Spark picks a broadcast by bytes.
    """
    cand_tbl, base_tbl, excl_tbl = VARIANTS[variant]
    base = neighbour_handles(raw[base_tbl], base_actor, start, end)
    exclude = neighbour_handles(raw[excl_tbl], base_actor, start, end)
    return core(incremental_edges(raw[cand_tbl], start, end, actors=base), None, exclude)


def stored_views(core, edges: dict[str, DataFrame], variant: str, base_actor: str) -> DataFrame:
    """A ranking view over stored M1 / M2 (``edges``): one semi-join and one aggregate, no window."""
    cand_tbl, base_tbl, excl_tbl = VARIANTS[variant]
    base = actor_filter(edges[base_tbl], base_actor).select("handle")
    exclude = base if excl_tbl == base_tbl else actor_filter(edges[excl_tbl], base_actor).select("handle")
    return core(restrict_actor(edges[cand_tbl], base), None, exclude)


def recommend_stored(followers: DataFrame, follows: DataFrame, variant: str, base_actor: str) -> DataFrame:
    """One of M7-M10 as the reference defines it: a view over the stored M1 and M2."""
    return stored_views(two_hop, {"followers": followers, "follows": follows}, variant, base_actor)


def popularity_stored(followers: DataFrame, follows: DataFrame, variant: str, base_actor: str) -> DataFrame:
    """M12 over the stored M1 and M2."""
    return stored_views(popularity, {"followers": followers, "follows": follows}, variant, base_actor)


def recommend(raw_followers: DataFrame, raw_follows: DataFrame, variant: str,
              base_actor: str, start, end) -> DataFrame:
    """One of M7-M10 from the raw edge tables (literal ``follower_count``)."""
    return _model(two_hop, {"followers": raw_followers, "follows": raw_follows},
                  variant, base_actor, start, end)


def popularity_ranked(raw_followers: DataFrame, raw_follows: DataFrame, variant: str,
                      base_actor: str, start, end) -> DataFrame:
    """M12 for one of the four variants."""
    return _model(popularity, {"followers": raw_followers, "follows": raw_follows},
                  variant, base_actor, start, end)


def followers_of_followers(raw_followers, raw_follows, base_actor, start, end) -> DataFrame:
    """M7: who follows the accounts that follow the base actor."""
    return recommend(raw_followers, raw_follows, "followers_of_followers", base_actor, start, end)


def followers_of_follows(raw_followers, raw_follows, base_actor, start, end) -> DataFrame:
    """M8: who follows the accounts the base actor follows."""
    return recommend(raw_followers, raw_follows, "followers_of_follows", base_actor, start, end)


def follows_of_followers(raw_followers, raw_follows, base_actor, start, end) -> DataFrame:
    """M9: whom the base actor's followers follow."""
    return recommend(raw_followers, raw_follows, "follows_of_followers", base_actor, start, end)


def follows_of_follows(raw_followers, raw_follows, base_actor, start, end) -> DataFrame:
    """M10 (flagship): whom the accounts the base actor follows follow."""
    return recommend(raw_followers, raw_follows, "follows_of_follows", base_actor, start, end)
