"""Sources and sinks: landed pages, load bookkeeping, size-cut files, external copies."""

import datetime as dt
import glob

import pytest
from pyspark.errors import NumberFormatException
from pyspark.sql import functions as F

from hopgraph.functions.scalar import day_bounds
from hopgraph.plans import edges as E
from hopgraph.schemas import JETSTREAM, LOAD_DATE
from hopgraph.sources import testdata as TD
from hopgraph.sources.external import append_external
from hopgraph.sources import loads as L
from hopgraph.sources.crawl import cursor_chains
from hopgraph.sources.ingest import child_tables, flatten_nested, ingest_pages
from hopgraph.sources.loads import append_load, finished_loads, loads_between, row_id
from hopgraph.sources.pond import write_pond

from conftest import SF_SMALL


def local(path):
    return path.replace("file:", "")


def test_pages_round_trip(spark):
    path = TD.write_pages(spark, SF_SMALL)
    for kind in ("followers", "follows"):
        profiles = flatten_nested(ingest_pages(spark, f"{path}/kind={kind}", kind))
        raw = TD.raw_edges(spark, SF_SMALL, kind)
        got = profiles.select(F.col("request_actor").alias("actor"), "handle", "did", "display_name")
        assert sorted(got.collect()) == sorted(raw.select("actor", "handle", "did", "display_name").collect())
    pages = spark.read.json(f"{path}/kind=follows")
    assert pages.select(F.max(F.size("follows"))).first()[0] <= TD.PAGE_SIZE


def test_append_load_ids_and_ledger(spark, scratch):
    base = scratch("loads")
    df = spark.createDataFrame([("a", "x"), ("b", "y")], "actor string, handle string")
    append_load(df, f"{base}/t", "1704067200.000001", ["actor", "handle"], ledger_path=f"{base}/ledger",
                inserted_at=F.lit("2024-01-01 00:00:00").cast("timestamp"))
    append_load(df, f"{base}/t", "1704067300.000002", ["actor", "handle"], ledger_path=f"{base}/ledger",
                inserted_at=F.lit("2024-01-01 00:01:40").cast("timestamp"))
    rows = spark.read.parquet(f"{base}/t")
    assert rows.count() == 4 and rows.select("_dlt_id").distinct().count() == 4
    assert {len(r[0]) for r in rows.select("_dlt_id").collect()} == {64}
    ledger = spark.read.parquet(f"{base}/ledger").orderBy("load_id").collect()
    assert [r["load_id"] for r in ledger] == ["1704067200.000001", "1704067300.000002"]
    assert {r["status"] for r in ledger} == {0} and len({r["schema_version_hash"] for r in ledger}) == 1
    # the id is a pure function of its inputs: a retried task writes the same ids
    again = df.select(row_id([F.lit("1704067200.000001"), "actor", "handle"]).alias("i")).collect()
    first = rows.where(F.col("_dlt_load_id") == "1704067200.000001").select("_dlt_id").collect()
    assert sorted(r[0] for r in again) == sorted(r[0] for r in first)


def test_load_days_prune_the_scan_and_keep_the_exact_range(spark, scratch):
    path = scratch("loads-pruned") + "/t"
    raw = TD.raw_edges(spark, SF_SMALL, "follows").drop("_dlt_load_id", "_dlt_id")
    for load in ("1704800000.5", "1704844800.25", "1704884400.0", "1704931200.0"):     # Jan 9, 10 (twice), 11
        append_load(raw, path, load, ["actor", "handle", "did"])
    landed = spark.read.parquet(path)
    start, end = dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 10, 6)                # the first load of the day
    pruned = E.incremental_follows(loads_between(landed, start, end), start, end)
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    filters = [line.split("PartitionFilters")[1].split("PushedFilters")[0]
               for line in plan.splitlines() if "PartitionFilters" in line]
    assert filters and all(LOAD_DATE in f for f in filters)
    rows = sorted(pruned.collect(), key=str)
    assert {r["_dlt_load_id"] for r in rows} == {"1704844800.25"}
    assert rows == sorted(E.incremental_follows(landed.drop(LOAD_DATE), start, end).collect(), key=str)


def test_append_load_days(spark, scratch):
    path = scratch("load-days") + "/t"
    df = spark.createDataFrame([("a", "x")], "actor string, handle string")
    # the last microsecond of a day and the first of the next
    for load in ("1704153599.999999", "1704153600.0"):
        append_load(df, path, load, ["actor", "handle"])
    # an id that is no time, which M1 could not read, is refused before it is written
    with pytest.raises(NumberFormatException):
        append_load(df, path, "manual", ["actor", "handle"])
    landed = spark.read.parquet(path)
    day = lambda d: [r[0] for r in loads_between(landed, *day_bounds(d, d)).select("_dlt_load_id").collect()]
    assert day("2024-01-01") == ["1704153599.999999"] and day("2024-01-02") == ["1704153600.0"]
    assert landed.count() == 2 and LOAD_DATE not in loads_between(landed, *day_bounds("2024-01-01", "2024-01-02")).columns


def test_pond_cuts_files_by_bytes(spark, scratch):
    """Rows of 10 bytes and of 1 MB, mixed: every file but the last is within one row of the target."""
    big = 1 << 20
    df = spark.range(3000).select("id", F.when(F.col("id") % 300 == 7, F.repeat(F.lit("x"), big)).otherwise("tiny").alias("v"))
    df = df.repartition(5)
    path, target = scratch("pond"), 2 * big
    n = write_pond(df, path, target_bytes=target)
    sizes = [spark.read.parquet(f).select(F.sum(F.length(F.to_json(F.struct("id", "v"))))).first()[0]
             for f in glob.glob(local(path) + "/*.parquet")]
    assert len(sizes) == n == 6
    assert all(target - big - 100 <= s <= target + big + 100 for s in sorted(sizes)[1:])
    assert spark.read.parquet(path).agg(F.count("*"), F.sum("id"), F.sum(F.length("v"))).first() == \
        df.agg(F.count("*"), F.sum("id"), F.sum(F.length("v"))).first()
    raw = TD.raw_edges(spark, SF_SMALL, "follows")
    packed = scratch("pond-packed")
    assert write_pond(raw.repartition(8), packed) == 1              # far below one file's size
    assert len(glob.glob(local(packed) + "/*.parquet")) == 1
    assert sorted(spark.read.parquet(packed).collect()) == sorted(raw.collect())
    assert write_pond(raw.where("false"), scratch("pond-empty")) == 1


def test_external_copy_bootstrap_and_append(spark, scratch):
    src = TD.landed_jetstream_path(spark, SF_SMALL)
    n = spark.read.schema(JETSTREAM).parquet(src).count()
    dst = scratch("jet-copy")
    assert append_external(spark, src, dst, JETSTREAM, ["year", "month", "day"], bootstrap=True).count() == n
    # bootstrapping again is a no-op; appending again duplicates every row (no dedup)
    assert append_external(spark, src, dst, JETSTREAM, ["year", "month", "day"], bootstrap=True).count() == n
    assert append_external(spark, src, dst, JETSTREAM, ["year", "month", "day"]).count() == 2 * n


def test_malformed_page_fails(spark, tmp_path):
    """A page that is no JSON fails the read instead of vanishing."""
    (tmp_path / "pages.json").write_text('{"followers":[{"did":"d1","handle":"a"}],"cursor":"c"}\n{"followers":[{"did"\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        ingest_pages(spark, str(tmp_path), "followers").collect()


def test_row_ids_keep_nulls_apart(spark):
    df = spark.createDataFrame([("a", "b", None), ("a", None, "b")], "x string, y string, z string")
    ids = [r[0] for r in df.select(row_id(["x", "y", "z"])).collect()]
    assert len(set(ids)) == 2 and all(len(i) == 64 for i in ids)


def test_listed_load_is_not_appended_again(spark, scratch):
    df = spark.createDataFrame([("u0", "a"), ("u0", "b")], "actor string, handle string")
    path, ledger = scratch("again"), scratch("again-ledger")
    for _ in range(2):
        append_load(df, path, "1704067200.000001", ["actor", "handle"], ledger_path=ledger)
    assert spark.read.parquet(path).count() == 2 and spark.read.parquet(ledger).count() == 1


def test_crash_between_files_and_ledger(spark, scratch, monkeypatch):
    """A run that dies before its ledger entry is invisible; the retry holds each row once."""
    df = spark.createDataFrame([("u0", "a"), ("u0", "b")], "actor string, handle string")
    path, ledger = scratch("crash"), scratch("crash-ledger")
    append_load(df, path, "1704067200.000001", ["actor", "handle"], ledger_path=ledger)
    later = df.withColumn("actor", F.lit("u1")), path, "1704067300.000002", ["actor", "handle"]
    with monkeypatch.context() as m:
        m.setattr(L, "loads_ledger", lambda *_: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError, match="killed"):
            append_load(*later, ledger_path=ledger)
    read = lambda: finished_loads(spark.read.parquet(path), spark.read.parquet(ledger))
    assert spark.read.parquet(path).count() == 4 and sorted(r.actor for r in read().collect()) == ["u0", "u0"]
    append_load(*later, ledger_path=ledger)
    assert sorted((r.actor, r.handle) for r in read().collect()) == [("u0", "a"), ("u0", "b"), ("u1", "a"), ("u1", "b")]
    assert spark.read.parquet(path).count() == 4 and spark.read.parquet(ledger).count() == 2
    plan = read()._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan                  # unfinished loads are pruned, not read


def test_cursor_chains(spark):
    chains = {"whole": [(None, "1"), ("1", "2"), ("2", None)], "one": [("", "")], "hole": [(None, "1"), ("2", "3"), ("3", "")],
              "circle": [(None, "1"), ("1", "2"), ("2", "1")], "headless": [("1", "2"), ("2", None)],
              "self": [(None, "1"), ("1", "1")], "twice": [(None, "1"), (None, "1"), ("1", None)],
              "long": [(None, "1")] + [(str(i), str(i + 1)) for i in range(1, 600)]}
    df = spark.createDataFrame([(a, c, n) for a, p in chains.items() for c, n in p], "actor string, cursor string, next_cursor string")
    got = {r.actor: tuple(r)[1:] for r in cursor_chains(df).collect()}
    assert got == {"whole": (3, 3, "complete", None), "one": (1, 1, "complete", None), "hole": (3, 1, "broken", "1"),
                   "circle": (3, None, "cyclic", None), "headless": (2, 0, "no first page", None),
                   "self": (2, None, "cyclic", None), "twice": (2, 2, "complete", None), "long": (600, 600, "broken", "600")}
    assert cursor_chains(df.where("false")).collect() == []


def test_child_tables_join_back(spark):
    schema = ("id int, who struct<name: string, tags: array<string>>, "
              "posts: array<struct<text: string, likes: array<struct<did: string>>>>")
    data = [(1, ("ann", ["x", "y"]), [("p0", [("d1",), ("d2",)]), ("p1", [])]), (2, ("bob", None), None),
            (3, ("cat", []), [("p2", None), None])]
    t = child_tables(spark.createDataFrame(data, schema), "accounts", ["id"])
    assert sorted(t) == ["accounts", "accounts__posts", "accounts__posts__likes", "accounts__who__tags"]
    assert sorted(t["accounts"].select("id", "who__name").collect()) == [(1, "ann"), (2, "bob"), (3, "cat")]

    def lists(child, parent, *value):
        joined = t[child].alias("c").join(t[parent].alias("p"), F.col("c._dlt_parent_id") == F.col("p._dlt_id"))
        return joined.orderBy("c._dlt_parent_id", "c._dlt_list_idx").select(*value).collect()
    assert sorted(map(tuple, lists("accounts__who__tags", "accounts", "p.id", "c._dlt_list_idx", "c.value"))) == [(1, 0, "x"), (1, 1, "y")]
    posts = sorted(map(tuple, lists("accounts__posts", "accounts", "p.id", "c._dlt_list_idx", "c.text")), key=repr)
    assert posts == [(1, 0, "p0"), (1, 1, "p1"), (3, 0, "p2"), (3, 1, None)]
    assert sorted(map(tuple, lists("accounts__posts__likes", "accounts__posts", "p.text", "c.did"))) == [("p0", "d1"), ("p0", "d2")]
