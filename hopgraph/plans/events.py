"""Event projection: M11.

Flattens the nested firehose record into typed columns and builds a profile
URL for the record's subject.  ``strip_json_quotes=False`` reproduces the
reference literally: ``uri`` keeps its JSON quotes, so the URL ends in a
stray quote; ``True`` gives clean URLs.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hopgraph.functions.scalar import (
    as_datetime, json_field, lenient_ts_parse, map_get, micros_to_ts, null_concat, split_part, strip_quotes,
)
from hopgraph.operators.projection import ts_literal, with_aliases

# The public profile URL prefix and the lexicon marker in URIs.
PROFILE_URL_PREFIX = "https://bsky.app/profile/"
LEXICON_MARKER = "/app.bsky"

EVENT_COLUMNS = ["did", "kind", "ts", "collection", "record", "createdAt", "subject", "uri",
                 "bsky_subject_url"]


def subject_url(uri: str = "uri"):
    """F5 + F6: profile URL of an ``at://`` URI (NULL when the URI is NULL)."""
    return null_concat(
        PROFILE_URL_PREFIX,
        split_part(split_part(uri, LEXICON_MARKER, 1), "at://", 2), "/",
        split_part(split_part(uri, "/", 4), ".", -1), "/",
        split_part(uri, "/", -1))


_EPOCH = dt.datetime(1970, 1, 1)


def _micros(x) -> int:
    return (as_datetime(x) - _EPOCH) // dt.timedelta(microseconds=1)


def partition_prune(jet: DataFrame, start, end, derived_days: bool = False) -> DataFrame:
    """Scan-level forms of ``ts BETWEEN start AND end``.

    ``ts`` is computed from ``time_us``, so its filter alone does not reach
    Parquet statistics; the equal ``time_us`` range does.  With
    ``derived_days`` the year/month/day partition columns are pruned as well.
    That is right only for a table whose writer derived them from
    ``time_us``: elsewhere they may be NULL or hold the ingest day.
    """
    cols = set(jet.columns)
    if "time_us" in cols:
        jet = jet.where(F.col("time_us").between(F.lit(_micros(start)), F.lit(_micros(end))))
    if not derived_days or not {"year", "month", "day"} <= cols:
        return jet
    day = F.make_date(F.col("year").cast("int"), F.col("month").cast("int"), F.col("day").cast("int"))
    return jet.where(day.between(F.lit(as_datetime(start).date()), F.lit(as_datetime(end).date())))


def jetstream_events(jet: DataFrame, start, end, strip_json_quotes: bool = False,
                     derived_days: bool = False) -> DataFrame:
    """Did, kind, ts, collection, record, createdAt, subject, uri, bsky_subject_url."""
    rec = F.col("commit.record")
    projected = with_aliases(partition_prune(jet, start, end, derived_days), [
        ("ts", micros_to_ts("time_us")),
        ("collection", F.col("commit.collection")),
        ("record", rec),
        ("createdAt", lenient_ts_parse(strip_quotes(map_get(rec, "createdAt")))),
        ("subject", map_get(rec, "subject")),
        ("uri", lambda: json_field("subject", "uri", keep_quotes=not strip_json_quotes)),
        ("bsky_subject_url", lambda: subject_url("uri")),
    ])
    return (projected.where(F.col("ts").between(ts_literal(start), ts_literal(end)))
            .select(*EVENT_COLUMNS))
