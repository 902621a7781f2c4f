"""Materialisation properties: replayed upserts, split intervals, versioned writes."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from hopgraph.plans import stored as ST
from hopgraph.plans.materialize import HourlyTable, overwrite_interval, upsert_by_key, upsert_newest

SCHEMA = "handle string, actor string, t timestamp_ntz, v string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


D = [dt.datetime(2024, 1, d) for d in range(1, 6)]


def test_upsert_replay_and_last_batch_wins(spark):
    keys = ["handle", "actor"]
    b1 = frame(spark, [("h", "a", D[0], "old"), ("k", "a", D[0], "k1"), (None, "a", D[0], "n1")])
    b2 = frame(spark, [("h", "a", D[2], "new"), (None, "a", D[2], "n2")])
    second = upsert_by_key(b1, b2, keys)
    after = rows(second)
    assert ("h", "a", D[2], "new") in after and ("h", "a", D[0], "old") not in after
    assert len([r for r in after if r[0] is None]) == 2                # NULL keys never match
    assert upsert_by_key(second, b2, keys).count() == len(after) + 1   # replay: only the NULL-key row comes again
    b1, b2 = b1.dropna(subset=["handle"]), b2.dropna(subset=["handle"])
    second = upsert_by_key(b1, b2, keys)
    assert rows(upsert_by_key(second, b2, keys)) == rows(second)
    # Re-running the old batch puts the old row back.
    assert ("h", "a", D[0], "old") in rows(upsert_by_key(second, b1, keys))


def test_upsert_newest_ignores_stale_batch(spark):
    stored = frame(spark, [("h", "a", D[2], "new")])
    batch = frame(spark, [("h", "a", D[0], "old"), ("k", "a", D[0], "k")])
    assert rows(upsert_newest(stored, batch, ["handle", "actor"], "t")) == [("h", "a", D[2], "new"), ("k", "a", D[0], "k")]


def test_interval_overwrite_split_equals_whole(spark):
    src = frame(spark, [(f"h{i}", "a", dt.datetime(2024, 1, 1 + i % 5, i % 24), f"v{i}") for i in range(40)])
    empty = src.where("false")
    last = D[4].replace(hour=23)
    whole = overwrite_interval(empty, src, "t", D[0], last)
    cut = dt.datetime(2024, 1, 3, 12, 30)
    split = overwrite_interval(empty, src, "t", D[0], cut)
    split = overwrite_interval(split, src, "t", cut.replace(minute=0), last)
    assert rows(split) == rows(whole)
    # An interval the batch leaves empty is emptied (no stale partition).
    cleared = overwrite_interval(split, empty, "t", D[1], D[1].replace(hour=23))
    assert rows(cleared) == rows(whole.where(F.to_date("t") != F.lit(D[1].date())))


def name():
    return f"t_{uuid.uuid4().hex[:8]}"


KEYS = ["handle", "actor"]


def test_repeated_key_fails_the_write(spark):
    """The uniqueness audit is part of the job that writes: nothing is stored or published."""
    first, second = name(), name()
    ST.store(frame(spark, [("h", "a", D[0], "v1")]), first, KEYS, 4)
    view = ST.publish(spark, f"v_{first}", first)
    twice = frame(spark, [("h", "a", D[1], "x"), ("h", "a", D[2], "y"), (None, "a", D[1], "n"), (None, "a", D[1], "m")])
    with pytest.raises(Exception, match="key is not unique"):
        ST.upsert(first, twice, KEYS, second, 4)
    with pytest.raises(Exception, match="key is not unique"):
        ST.store(twice, name(), KEYS, 4)
    assert not spark.catalog.tableExists(ST.qualified(spark, second))
    assert rows(view) == [("h", "a", D[0], "v1")]
    assert ST.store(twice.where("handle IS NULL"), name(), KEYS, 4).count() == 2       # NULL keys are not checked


def test_stored_upsert_leaves_the_target_where_it_is(spark):
    """Only the batch is exchanged; one file a bucket; the view moves when the new table is whole."""
    first, second, third = name(), name(), name()
    old = frame(spark, [(f"h{i}", "a", D[0], f"old{i}") for i in range(40)] + [(None, "a", D[0], "n")])
    ST.store(old, first, KEYS, 8)
    batch = frame(spark, [("h3", "a", D[2], "new3"), ("k", "a", D[2], "k"), (None, "a", D[2], "m")])
    plan = ST.merged(spark.table(ST.qualified(spark, first)), batch, KEYS, 8)._jdf.queryExecution().executedPlan().toString()
    target = plan[plan.index("SortMergeJoin"):].split("_new_handle", 2)[1]
    assert plan.count("Exchange hashpartitioning") == 1 and "Exchange" not in target.split("FileScan")[0]
    stored = ST.upsert(first, batch, KEYS, second, 8)
    assert len(stored.inputFiles()) <= 8
    assert rows(stored) == rows(upsert_by_key(old, batch, KEYS))
    again = ST.upsert(second, batch.dropna(subset=KEYS), KEYS, third, 8)         # replaying changes nothing
    assert rows(again) == rows(stored)
    view = f"v_{first}"
    assert ST.publish(spark, view, first).count() == 41 and ST.publish(spark, view, second).count() == 43


def test_stored_upsert_newest(spark):
    first, second = name(), name()
    ST.store(frame(spark, [("h", "a", D[2], "new"), ("i", "a", D[0], "old")]), first, KEYS, 4)
    batch = frame(spark, [("h", "a", D[0], "late"), ("i", "a", D[1], "newer"), ("k", "a", D[0], "k")])
    assert rows(ST.upsert(first, batch, KEYS, second, 4, newest=["t"])) == [
        ("h", "a", D[2], "new"), ("i", "a", D[1], "newer"), ("k", "a", D[0], "k")]


def test_hourly_reload_touches_only_its_hours(spark):
    import uuid
    from hopgraph.plans.materialize import HourlyTable
    table = HourlyTable(spark, f"t_{uuid.uuid4().hex[:8]}", "t")
    hours = [dt.datetime(2024, 1, 1, h, 15) for h in range(6)]

    def source(tag, skip=()):
        data = [(f"h{i}", "a", t, f"{tag}{i}") for i, t in enumerate(hours) if i not in skip]
        df = frame(spark, data)
        return lambda lo, hi: df.where(F.col("t").between(F.lit(lo), F.lit(hi)))

    table.reload(source("v1-"), hours[0], hours[-1])
    assert sorted(r["v"] for r in table.read().collect()) == [f"v1-{i}" for i in range(6)]
    # reload 02:30..03:10 (widened to hours 2 and 3); hour 3 now has no rows in the source
    table.reload(source("v2-", skip={3}), dt.datetime(2024, 1, 1, 2, 30), dt.datetime(2024, 1, 1, 3, 10))
    assert sorted(r["v"] for r in table.read().collect()) == ["v1-0", "v1-1", "v1-4", "v1-5", "v2-2"]


def test_hourly_reload_clips_and_empties(spark):
    """Rows outside the interval are not reloaded; hours the batch leaves empty are cleared."""
    rows = spark.createDataFrame([(dt.datetime(2024, 1, 1, h, 30), h) for h in range(4)],
                                 "ts timestamp_ntz, v int")
    table = HourlyTable(spark, f"clip_{uuid.uuid4().hex[:8]}", "ts")
    table.reload(lambda lo, hi: rows, dt.datetime(2024, 1, 1, 0), dt.datetime(2024, 1, 1, 3))
    assert table.read().count() == 4
    table.reload(lambda lo, hi: rows, dt.datetime(2024, 1, 1, 1), dt.datetime(2024, 1, 1, 1, 59))
    assert table.read().count() == 4
    table.reload(lambda lo, hi: rows.limit(0), dt.datetime(2024, 1, 1, 1), dt.datetime(2024, 1, 1, 2))
    assert sorted(r.v for r in table.read().collect()) == [0, 3]


def test_hourly_reload_keeps_hours_when_the_batch_fails(spark):
    rows = spark.createDataFrame([(dt.datetime(2024, 1, 1, 1, 30), 1)], "ts timestamp_ntz, v int")
    table = HourlyTable(spark, f"fail_{uuid.uuid4().hex[:8]}", "ts")
    bounds = dt.datetime(2024, 1, 1, 1), dt.datetime(2024, 1, 1, 1, 59)
    table.reload(lambda lo, hi: rows, *bounds)
    with pytest.raises(Exception, match="broken batch"):
        table.reload(lambda lo, hi: rows.withColumn("v", F.raise_error(F.lit("broken batch")).cast("int")), *bounds)
    assert table.read().count() == 1
