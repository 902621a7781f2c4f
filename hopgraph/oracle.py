"""DuckDB SQL that states each registered query independently of Spark.

The driver runs these next to the Spark queries on the same parquet tables.
Common table expressions re-derive the reference-shaped inputs from
``events`` (the mapping in ``hopgraph.sources.testdata``); the model bodies
follow the reference's SQL, adapted to DuckDB 2.0 where noted.
"""

from __future__ import annotations

import datetime as dt

from hopgraph.sources.testdata import (
    AVATAR_PREFIX, COLLECTION_BY_EVENT, DEFAULT_COLLECTION, DID_PREFIX, LOAD_SCHEMA_HASH,
    LOAD_SCHEMA_NAME, SUBJECT_DID_MODULUS,
)


def ts_lit(x: dt.datetime) -> str:
    return f"TIMESTAMP '{x.isoformat(sep=' ')}'"


def load_text(ts: str) -> str:
    return (f"CAST(epoch_us({ts}) // 1000000 AS VARCHAR) || '.' || "
            f"lpad(CAST(epoch_us({ts}) % 1000000 AS VARCHAR), 6, '0')")


_collection = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in COLLECTION_BY_EVENT.items())

# name -> (body, dependencies)
_CTES: dict[str, tuple[str, list[str]]] = {
    "pairs": ("""
  SELECT e.event_id AS e_id, e.ts AS e_ts, e.user_id AS e_user, e.event_type AS e_type,
         f.event_id AS f_id, f.ts AS f_ts, f.user_id AS f_user, f.event_type AS f_type
  FROM events e JOIN events f ON f.event_id = e.event_id + 1
  WHERE e.event_type IN ('click', 'view') AND e.user_id <> f.user_id""", []),
    "raw_edges": (f"""
  SELECT CASE WHEN e_type = 'click' THEN 'follows' ELSE 'followers' END AS tbl,
    '{DID_PREFIX}' || CAST(f_user AS VARCHAR) AS did,
    'u' || CAST(f_user AS VARCHAR) AS handle,
    CASE WHEN f_id % 5 = 0 THEN '' ELSE 'User ' || CAST(f_user AS VARCHAR) END AS display_name,
    '{AVATAR_PREFIX}' || CAST(f_user AS VARCHAR) AS avatar,
    f_ts AS created_at,
    CASE WHEN f_type <> 'error' THEN f_type END AS description,
    e_ts AS indexed_at,
    'u' || CAST(e_user AS VARCHAR) AS actor,
    {load_text('e_ts')} AS _dlt_load_id,
    'row-' || CAST(e_id AS VARCHAR) AS _dlt_id,
    CASE e_id % 3 WHEN 0 THEN 'all' WHEN 1 THEN 'following' END AS associated__chat__allow_incoming,
    CASE e_id % 10 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END AS associated__labeler,
    e_id, f_id, f_ts, e_ts, f_user, e_user, f_type, e_type
  FROM pairs""", ["pairs"]),
    "raw_followers": ("""
  SELECT did, handle, display_name, avatar, created_at, description, indexed_at, actor,
         _dlt_load_id, _dlt_id, associated__chat__allow_incoming, associated__labeler
  FROM raw_edges WHERE tbl = 'followers'""", ["raw_edges"]),
    "raw_follows": ("""
  SELECT did, handle, display_name, avatar, created_at, description, indexed_at, actor,
         _dlt_load_id, _dlt_id, associated__chat__allow_incoming, associated__labeler
  FROM raw_edges WHERE tbl = 'follows'""", ["raw_edges"]),
    "raw_loads": (f"""
  SELECT {load_text('first_ts')} AS load_id, '{LOAD_SCHEMA_NAME}' AS schema_name,
         CAST(0 AS BIGINT) AS status, first_ts AS inserted_at,
         '{LOAD_SCHEMA_HASH}' AS schema_version_hash
  FROM (SELECT CAST(ts AS DATE) AS d, min(ts) AS first_ts FROM events GROUP BY 1)""", []),
    "jet": (f"""
  SELECT event_id, user_id, event_type, ts,
    '{DID_PREFIX}' || CAST(user_id AS VARCHAR) AS did, 'commit' AS kind, epoch_us(ts) AS time_us,
    CASE event_type {_collection} ELSE '{DEFAULT_COLLECTION}' END AS collection,
    'create' AS operation,
    '"' || strftime(ts, '%Y-%m-%dT%H:%M:%S')
        || CASE WHEN event_id % 7 = 0 THEN ''
                ELSE '.' || lpad(CAST((epoch_us(ts) % 1000000) // 1000 AS VARCHAR), 3, '0') END
        || 'Z"' AS created_text,
    CASE WHEN event_type IN ('click', 'view')
           THEN '{{"cid":"c' || CAST(event_id AS VARCHAR) || '","uri":"at://{DID_PREFIX}'
                || CAST((user_id + event_id) % {SUBJECT_DID_MODULUS} AS VARCHAR)
                || '/app.bsky.feed.post/k' || CAST(event_id AS VARCHAR) || '"}}'
         WHEN event_type = 'purchase'
           THEN '"{DID_PREFIX}' || CAST((user_id + event_id) % {SUBJECT_DID_MODULUS} AS VARCHAR) || '"'
    END AS subject_text,
    year(ts) AS year, month(ts) AS month, day(ts) AS day, hour(ts) AS hour
  FROM events""", []),
    "jetstream": ("""
  SELECT did, kind, time_us, collection, operation, year, month, day, hour,
    CASE WHEN subject_text IS NULL THEN MAP {'createdAt': created_text}
         ELSE MAP {'createdAt': created_text, 'subject': subject_text} END AS record
  FROM jet""", ["jet"]),
    "outcomes": ("""
  SELECT 'u' || CAST(user_id AS VARCHAR) AS actor, event_type <> 'error' AS success,
         CASE WHEN event_type = 'error' THEN 'HTTP 429 Too Many Requests' END AS error,
         value AS duration_s
  FROM events""", []),
}


def incremental_cte(table: str, start: dt.datetime | None, end: dt.datetime | None,
                    name: str | None = None):
    """M1/M2 as the reference states it (QUALIFY), with a deterministic tiebreak.

    Without bounds the range filter is left out (the latest-per-key step alone).
    """
    where = ("" if start is None else
             f"WHERE timezone('UTC', to_timestamp(_dlt_load_id::DOUBLE)) BETWEEN {ts_lit(start)} AND {ts_lit(end)}")
    body = f"""
  SELECT did::TEXT AS did, handle::TEXT AS handle, display_name::TEXT AS display_name,
    avatar::TEXT AS avatar, created_at::TIMESTAMP AS created_at,
    description::TEXT AS description, indexed_at::TIMESTAMP AS indexed_at,
    actor::TEXT AS actor, _dlt_load_id::TEXT AS _dlt_load_id, _dlt_id::TEXT AS _dlt_id,
    associated__chat__allow_incoming::TEXT AS associated__chat__allow_incoming,
    associated__labeler::BOOLEAN AS associated__labeler,
    timezone('UTC', to_timestamp(_dlt_load_id::DOUBLE)) AS _dlt_load_time
  FROM raw_{table}
  {where}
  QUALIFY ROW_NUMBER() OVER (PARTITION BY handle, actor
                             ORDER BY _dlt_load_time DESC NULLS LAST, _dlt_id DESC NULLS LAST) = 1"""
    return (name or f"incremental_{table}", body, [f"raw_{table}"])


def base_cte(table: str, actor: str):
    return (f"base_actor_{table}", f"""
  SELECT DISTINCT did, handle, display_name
  FROM incremental_{table}
  WHERE actor = '{actor}'""", [f"incremental_{table}"])


def with_ctes(body: str, needs: list[str], extra: list[tuple[str, str, list[str]]] = ()) -> str:
    """``WITH`` clause holding ``needs`` and their dependencies, in order."""
    table = {k: (v, d) for k, (v, d) in _CTES.items()}
    for name, text, deps in extra:
        table[name] = (text, deps)
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in table[n][1]:
            visit(d)
        order.append(n)

    for n in needs:
        visit(n)
    ctes = ",\n".join(f"{n} AS ({table[n][0]}\n)" for n in order)
    return f"WITH {ctes}\n{body}"
