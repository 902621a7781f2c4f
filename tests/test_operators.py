"""Operators: NOT IN null semantics (D4), latest-per-key, audits, set operations, ingest."""

import contextlib
import datetime as dt
import io

from pyspark.sql import functions as F

from hopgraph.operators import (
    audit_unique, crawl_frontier, edge_join, in_range, latest_per_key, not_in, sentinel_filter,
)
from hopgraph.sources.ingest import flatten_nested, snake_case, tag_actor


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def handles(spark, values):
    return spark.createDataFrame([(v,) for v in values], "handle string")


def kept(df):
    return sorted((r["handle"] for r in df.collect()), key=lambda x: (x is None, x))


def test_not_in_matches_sql_semantics(spark):
    cand = handles(spark, ["a", "b", None, "c"])
    cand.createOrReplaceTempView("cand")
    cases = {
        "plain": ["b"],
        "with_null": ["b", None],
        "empty": [],
    }
    for name, excl in cases.items():
        ex = handles(spark, excl)
        ex.createOrReplaceTempView("ex")
        ours = kept(not_in(cand, "handle", ex))
        sql = kept(spark.sql("SELECT handle FROM cand WHERE NOT handle IN (SELECT handle FROM ex)"))
        assert ours == sql, name
    assert kept(not_in(cand, "handle", handles(spark, ["b"]))) == ["a", "c"]
    assert kept(not_in(cand, "handle", handles(spark, ["b", None]))) == []
    assert kept(not_in(cand, "handle", handles(spark, []))) == ["a", "b", "c", None]


def test_not_in_is_an_equi_anti_join(spark):
    plan = plan_text(not_in(handles(spark, ["a"]), "handle", handles(spark, ["b"])))
    assert "LeftAnti" in plan and "BroadcastNestedLoopJoin" not in plan


def test_latest_per_key_tiebreak_and_audit(spark):
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    rows = [("h", "a", t1, "x1"), ("h", "a", t2, "x2"), ("h", "a", t2, "x3"), ("h", "b", t1, "x4"),
            (None, "a", t1, "x5"), (None, "a", t2, "x6")]
    df = spark.createDataFrame(rows, "handle string, actor string, t timestamp_ntz, id string")
    assert audit_unique(df, ["handle", "actor"]).count() == 2
    latest = latest_per_key(df, ["handle", "actor"], "t", ["id"])
    assert sorted(r["id"] for r in latest.collect()) == ["x3", "x4", "x6"]
    assert audit_unique(latest, ["handle", "actor"]).count() == 0


def test_in_range_is_inclusive(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, d, 0, 0),) for d in (1, 2, 3)] +
                               [(dt.datetime(2024, 1, 3, 1, 0),)], "t timestamp_ntz")
    # A date bound is midnight, so 01:00 on the end day falls outside.
    assert in_range(df, "t", dt.date(2024, 1, 1), dt.date(2024, 1, 3)).count() == 3


def test_edge_join_keeps_duplicates(spark):
    edges = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "z")], "actor string, handle string")
    base = handles(spark, ["a", "a"])
    assert edge_join(edges, base).count() == 4


def test_frontier_flags(spark):
    fo = spark.createDataFrame([("u0", "a"), ("u0", "handle.invalid"), ("u9", "q")], "actor string, handle string")
    fl = spark.createDataFrame([("u0", "a"), ("u0", "b")], "actor string, handle string")
    assert kept(crawl_frontier(fo, fl, "u0")) == ["a", "b", "u0"]
    assert kept(crawl_frontier(fo, fl, "u0", drop_invalid=False, include_base=False)) == \
        ["a", "b", "handle.invalid"]
    assert kept(sentinel_filter(fo)) == ["a", "q"]


def test_flatten_and_tag(spark):
    assert snake_case("displayName") == "display_name" and snake_case("allowIncoming") == "allow_incoming"
    df = spark.createDataFrame(
        [("d1", "x", {"chat": {"allowIncoming": "all"}, "labeler": None})],
        "did string, indexedAt string, associated struct<chat: struct<allowIncoming: string>, labeler: boolean>")
    flat = flatten_nested(df)
    assert flat.columns == ["did", "indexed_at", "associated__chat__allow_incoming", "associated__labeler"]
    tagged = tag_actor(flat, "u0", ingest_time="2024-12-04T00:00:00")
    row = tagged.first()
    assert row["actor"] == "u0" and row["indexed_at"] == "2024-12-04T00:00:00"
    assert tag_actor(flat, F.lit("u1")).first()["indexed_at"] == "x"


def test_ranks_without_a_single_task(spark):
    """Gapless row numbers over several partitions; no window gathers the rows."""
    from pyspark.sql import functions as F
    from hopgraph.operators.rank import ranked
    df = spark.range(1000).select("id", (F.col("id") * 7919 % 13).alias("score")).repartition(6)
    out = ranked(df, [F.col("score").desc(), F.col("id")])
    assert [r["id"] for r in out.orderBy("rank").collect()] == [r["id"] for r in df.orderBy(F.col("score").desc(), "id").collect()]
    assert [r["rank"] for r in out.orderBy("rank").collect()] == list(range(1, 1001))
    assert ranked(df.where("false"), [F.col("id")]).collect() == []


def test_two_hop_views_read_stored_edges_without_a_window(spark):
    from hopgraph.queries import REGISTRY
    from conftest import SF_SMALL
    for name in ("dim_profiles", "view_model", "followers_of_followers", "followers_of_follows", "follows_of_followers",
                 "follows_of_follows", "popularity_ranked_follows_of_follows"):
        plan = REGISTRY[name].spark(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan
