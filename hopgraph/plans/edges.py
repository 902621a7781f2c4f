"""Edge models: M1-M6.

``incremental_edges`` is the typed, in-range, latest-per-(handle, actor) edge
table; ``base_actor_edges`` the accounts next to the base actor (an
embedded model: an unmaterialised DataFrame inlined into its callers);
``dim_profiles`` the profile dimension over both edge tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hopgraph.functions.scalar import epoch_seconds_to_ts
from hopgraph.operators.joins import restrict_actor
from hopgraph.operators.aggregate import distinct_rows
from hopgraph.operators.projection import actor_filter, in_range, typed_projection
from hopgraph.operators.setops import union_all
from hopgraph.operators.window import latest_per_key
from hopgraph.schemas import EDGE, EDGE_KEY, LOADS, PROFILE_COLUMNS

BASE_COLUMNS = ["did", "handle", "display_name"]


def typed_edges(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """P1 + F1: declared types, naive timestamps and the parsed load time (one projection).

    ``keep`` names extra columns carried through unchanged (e.g. a table tag).
    """
    cols = [F.col(f.name).cast(f.dataType).alias(f.name) for f in EDGE.fields if f.name != "_dlt_load_time"]
    return raw.select(*cols, epoch_seconds_to_ts("_dlt_load_id").alias("_dlt_load_time"), *keep)


def incremental_edges(raw: DataFrame, start, end, actors: DataFrame | None = None) -> DataFrame:
    """M1 / M2: typed edges loaded in [start, end], newest row per (handle, actor).

    ``actors`` (optional, a frame with a ``handle`` column) restricts the
    result to edges whose actor is in it.  Because ``actor`` is a window
    partition key, filtering before the window gives the same rows, and only
    that neighbourhood is shuffled.  The window still clusters by both keys
    (``pin_session``), so a hot actor is not gathered into one task.
    """
    typed = in_range(typed_edges(raw), "_dlt_load_time", start, end)
    if actors is not None:
        typed = restrict_actor(typed, actors)
    return latest_per_key(typed, EDGE_KEY, "_dlt_load_time", ["_dlt_id"])


def incremental_followers(raw_followers: DataFrame, start, end) -> DataFrame:
    """M1."""
    return incremental_edges(raw_followers, start, end)


def incremental_follows(raw_follows: DataFrame, start, end) -> DataFrame:
    """M2."""
    return incremental_edges(raw_follows, start, end)


def incremental_loads(raw_loads: DataFrame, start, end) -> DataFrame:
    """M3: typed load ledger with ``_dlt_load_time``, loads in [start, end]."""
    typed = typed_projection(raw_loads, LOADS).withColumn(
        "inserted_at", F.col("inserted_at").cast("timestamp_ntz"))
    typed = typed.withColumn("_dlt_load_time", epoch_seconds_to_ts("load_id"))
    return in_range(typed, "_dlt_load_time", start, end)


def base_actor_edges(edges: DataFrame, base_actor: str) -> DataFrame:
    """M4 / M5: distinct (did, handle, display_name) next to the base actor.

    The actor filter is on a window partition key, so Catalyst pushes it
    below the latest-per-key window and down to the scan.
    """
    return distinct_rows(actor_filter(edges, base_actor), BASE_COLUMNS)


def dim_profiles(followers: DataFrame, follows: DataFrame) -> DataFrame:
    """M6: distinct profiles across both edge tables (not one row per did)."""
    return distinct_rows(union_all([followers, follows], PROFILE_COLUMNS), PROFILE_COLUMNS)


def dim_profiles_tagged(raw_both: DataFrame, start, end, tag: str = "tbl") -> DataFrame:
    """M6 from both raw edge tables stored as one, told apart by ``tag``.

    Latest-per-key keyed by (tag, handle, actor) equals the two tables'
    latest rows side by side, so one scan and one window replace two.
    """
    typed = in_range(typed_edges(raw_both, keep=(tag,)), "_dlt_load_time", start, end)
    latest = latest_per_key(typed, [tag, *EDGE_KEY], "_dlt_load_time", ["_dlt_id"])
    return distinct_rows(latest, PROFILE_COLUMNS)
