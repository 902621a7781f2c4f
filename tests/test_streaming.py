"""Streams equal their batch counterparts."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from hopgraph.plans.edges import incremental_follows
from hopgraph.plans.events import jetstream_events
from hopgraph.plans.materialize import HourlyTable, upsert_by_key
from hopgraph.queries import FULL
from hopgraph.schemas import EDGE_KEY, JETSTREAM, RAW_EDGE
from hopgraph.sources import testdata as TD
from hopgraph.streaming.edges import edges_of_log, edges_stream, newest_edges
from hopgraph.streaming.jetstream import closed_hours_stream, hourly_stream, jetstream_stream

from conftest import SF_SMALL


def rows(df):
    return sorted((tuple(r) for r in df.select(sorted(df.columns)).collect()), key=repr)


def test_jetstream_stream_equals_batch(spark, scratch):
    src = TD.landed_jetstream_path(spark, SF_SMALL)
    out, ckpt = scratch("t1-out"), scratch("t1-ckpt")
    jetstream_stream(spark, src, out, ckpt, *FULL, max_files_per_trigger=3).awaitTermination()
    streamed = spark.read.parquet(out).drop("batch_id").withColumn("record", F.to_json("record"))
    batch = jetstream_events(spark.read.schema(JETSTREAM).parquet(src), *FULL).withColumn(
        "record", F.to_json("record"))
    assert rows(streamed) == rows(batch)
    # A restart with the same checkpoint finds nothing new.
    jetstream_stream(spark, src, out, ckpt, *FULL).awaitTermination()
    assert spark.read.parquet(out).count() == batch.count()
    # Another checkpoint would number its batches anew over the stored ones.
    with pytest.raises(ValueError, match="another checkpoint"):
        jetstream_stream(spark, src, out, scratch("t1-ckpt-new"), *FULL)


def test_newest_edges_equal_the_window_form(spark):
    raw = TD.raw_edges(spark, SF_SMALL, "follows")
    extra = raw.limit(30).withColumn("handle", F.lit(None).cast("string"))
    both = raw.unionByName(extra)
    assert rows(newest_edges(both, *FULL)) == rows(incremental_follows(both, *FULL))


def test_edge_stream_restarts_and_takes_files_in_any_order(spark, scratch):
    """Chunks land newest first, the stream stops in between and goes on from its checkpoint: equal to batch M2."""
    raw = TD.raw_edges(spark, SF_SMALL, "follows")
    src, log, ckpt = scratch("t2-src"), scratch("t2-log"), scratch("t2-ckpt")
    from hopgraph.functions.scalar import day_bounds, epoch_seconds_to_ts
    chunks = [("2024-01-21", "2999-12-31"), ("1900-01-01", "2024-01-10"), ("2024-01-11", "2024-01-20")]
    for n, (d1, d2) in enumerate(chunks):
        lo, hi = day_bounds(d1, d2)
        raw.where(epoch_seconds_to_ts("_dlt_load_id").between(F.lit(lo), F.lit(hi))).write.mode("append").parquet(src)
        if n == 1:
            continue                               # the second start finds two new chunks
        edges_stream(spark, src, log, ckpt, *FULL, max_files_per_trigger=2).awaitTermination()
    assert rows(edges_of_log(spark, log)) == rows(incremental_follows(raw, *FULL))
    before = spark.read.parquet(log).count()
    edges_stream(spark, src, log, ckpt, *FULL).awaitTermination()             # nothing new
    assert spark.read.parquet(log).count() == before


def test_edge_stream_out_of_order_keeps_the_newest(spark, scratch):
    t0 = dt.datetime(2024, 1, 1)

    def raw(load, name):
        return spark.createDataFrame(
            [("did:x", "x", name, None, t0, None, t0, "a", load, f"id{load}", None, None)], RAW_EDGE)
    src, log, ckpt = scratch("t2-ooo"), scratch("t2-ooo-log"), scratch("t2-ooo-ckpt")
    for load, text in (("1704200000.000000", "new"), ("1704100000.000000", "old")):
        raw(load, text).write.mode("append").parquet(src)
        edges_stream(spark, src, log, ckpt, *FULL).awaitTermination()
    assert [r["display_name"] for r in edges_of_log(spark, log).collect()] == ["new"]
    new, old = (incremental_follows(raw(*x), *FULL) for x in (("1704200000.000000", "new"), ("1704100000.000000", "old")))
    assert [r["display_name"] for r in upsert_by_key(new, old, EDGE_KEY).collect()] == ["old"]     # D7: last batch wins


def test_watermark_closes_hours_and_late_events_reload_only_theirs(spark, scratch):
    landed = spark.read.schema(JETSTREAM).parquet(TD.landed_jetstream_path(spark, SF_SMALL)).limit(9).collect()

    def land(path, *times):
        micros = [(t - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1) for t in times]
        rows_ = [{**landed[i % 9].asDict(), "time_us": m} for i, m in enumerate(micros)]
        spark.createDataFrame([tuple(r[f.name] for f in JETSTREAM) for r in rows_], JETSTREAM).coalesce(1) \
             .write.mode("append").parquet(path)

    def at(h, m=0):
        return dt.datetime(2024, 3, 1, h, m)

    src, ckpt, ledger, ledger_ckpt = (scratch(f"k5-{n}") for n in ("src", "ckpt", "closed", "closed-ckpt"))
    table = HourlyTable(spark, f"k5_{uuid.uuid4().hex[:8]}", "ts")
    reloaded, plain = [], table.reload_hours
    table.reload_hours = lambda build, hours: (reloaded.append({h.hour for h in hours}), plain(build, hours))

    def go():
        hourly_stream(spark, src, table, ckpt, *FULL, delay="3 hours").awaitTermination()
        closed_hours_stream(spark, src, ledger, ledger_ckpt, *FULL, delay="3 hours").awaitTermination()
        done, reloaded[:] = set().union(*reloaded), []
        return done

    land(src, at(5), at(6, 30), at(8), at(10, 59))
    assert go() == {5, 6, 8, 10}
    land(src, at(8, 10), at(11))                               # late, within the watermark (07:59)
    assert go() == {8, 11}
    batch = lambda: jetstream_events(spark.read.schema(JETSTREAM).parquet(src), *FULL)
    as_json = lambda df: rows(df.withColumn("record", F.to_json("record")))
    assert as_json(table.read()) == as_json(batch())           # every late event in its hour, equal to batch M11
    land(src, at(5, 1), at(11, 5))                             # 05:01 is behind the watermark (08:00)
    assert go() == {11}
    assert as_json(table.read()) == as_json(batch().where(F.col("ts") != F.lit(at(5, 1))))
    assert go() == set()                                       # nothing new
    closed = {r["hour"].hour: r["n_events"] for r in spark.read.parquet(ledger).collect()}
    assert closed == {5: 1, 6: 1}                              # hour 8 is still open at 08:05
