"""Declared schemas of the external tables and landed sources."""

from pyspark.sql.types import (
    ArrayType, BooleanType, DoubleType, LongType, MapType, StringType, StructField,
    StructType, TimestampNTZType, TimestampType,
)


def _s(*fields) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


# Raw edge tables (followers / follows) as landed by the crawler.
RAW_EDGE = _s(
    ("did", StringType()), ("handle", StringType()), ("display_name", StringType()),
    ("avatar", StringType()), ("created_at", TimestampType()), ("description", StringType()),
    ("indexed_at", TimestampType()), ("actor", StringType()), ("_dlt_load_id", StringType()),
    ("_dlt_id", StringType()), ("associated__chat__allow_incoming", StringType()),
    ("associated__labeler", BooleanType()),
)

# Modelled edge tables: naive timestamps plus the parsed load time.
EDGE = _s(
    ("did", StringType()), ("handle", StringType()), ("display_name", StringType()),
    ("avatar", StringType()), ("created_at", TimestampNTZType()), ("description", StringType()),
    ("indexed_at", TimestampNTZType()), ("actor", StringType()), ("_dlt_load_id", StringType()),
    ("_dlt_id", StringType()), ("associated__chat__allow_incoming", StringType()),
    ("associated__labeler", BooleanType()), ("_dlt_load_time", TimestampNTZType()),
)

EDGE_COLUMNS = [f.name for f in EDGE.fields]
RAW_EDGE_COLUMNS = [f.name for f in RAW_EDGE.fields]
PROFILE_COLUMNS = ["did", "handle", "display_name", "avatar", "description"]
EDGE_KEY = ["handle", "actor"]

# Partition column of tables landed by load: the day of the load time.
LOAD_DATE = "_dlt_load_date"
# And below it the load itself, as text that no reader takes for a number.
LOAD_PART = "_dlt_load"

# Load ledger.
LOADS = _s(
    ("load_id", StringType()), ("schema_name", StringType()), ("status", LongType()),
    ("inserted_at", TimestampType()), ("schema_version_hash", StringType()),
)

# Firehose event table, partitioned by year/month/day/hour.
JETSTREAM = _s(
    ("commit", _s(("cid", StringType()), ("collection", StringType()),
                  ("operation", StringType()),
                  ("record", MapType(StringType(), StringType())),  # values are JSON text
                  ("rev", StringType()), ("rkey", StringType()))),
    ("did", StringType()), ("kind", StringType()), ("time_us", LongType()),
    ("identity", _s(("did", StringType()), ("handle", StringType()), ("seq", LongType()),
                    ("time", StringType()))),
    ("account", _s(("active", BooleanType()), ("did", StringType()), ("seq", LongType()),
                   ("time", StringType()), ("status", StringType()))),
    ("day", LongType()), ("hour", LongType()), ("month", LongType()), ("year", LongType()),
)
JETSTREAM_PARTITIONS = ["year", "month", "day", "hour"]

# A profile as the public API returns it (camelCase, nested `associated`).
API_PROFILE = _s(
    ("did", StringType()), ("handle", StringType()), ("displayName", StringType()),
    ("avatar", StringType()), ("createdAt", StringType()), ("description", StringType()),
    ("indexedAt", StringType()),
    ("associated", _s(("chat", _s(("allowIncoming", StringType()))),
                      ("labeler", BooleanType()))),
)

# One landed API page: {followers | follows: [profile...], cursor}.
API_PAGE = _s(
    ("followers", ArrayType(API_PROFILE)), ("follows", ArrayType(API_PROFILE)),
    ("cursor", StringType()),
)

# One crawl outcome per actor.
CRAWL_OUTCOME = _s(
    ("actor", StringType()), ("success", BooleanType()), ("error", StringType()),
    ("duration_s", DoubleType()),
)
