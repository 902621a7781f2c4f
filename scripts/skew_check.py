"""Skew experiment: one account in a third of all edges, shuffle-tier plans.

    python scripts/skew_check.py [sf_dir] [copies] [skew_join: on|off] [users: repeat|unique|fanin]

Derives a skewed event table from the given ``events`` (``copies``
replicas with shifted ids; user 0 takes every third event, so ``u0`` is both
the actor and the handle of about a third of all edges; with ``unique`` every
other event gets a user of its own, so ``u0`` keeps a third of the edges
even after de-duplication; with ``fanin`` the base account ``u1`` follows a
third of all accounts and each of them follows ``u0``, so every two-hop
candidate points at one handle), lands its edges,
then runs M2 and the two-hop rankings with the key-set bounds forced to the
shuffle tier and automatic broadcasts switched off, as if the base set were
too large for any broadcast.  AQE thresholds are lowered
so its skew handling acts at this small size.  From the event log it prints,
per shuffle-reading stage, the task count and the largest and median task
shuffle read.  Results must equal the literal-tier plan.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def read_events(log_dir: str):
    import zstandard
    run = sorted(glob.glob(f"{log_dir}/*"), key=os.path.getmtime)[-1]
    files = sorted(glob.glob(f"{run}/events_*")) if os.path.isdir(run) else [run]
    for f in files:
        raw = open(f, "rb").read()
        if f.endswith(".zstd"):
            raw = zstandard.ZstdDecompressor().stream_reader(__import__("io").BytesIO(raw)).read()
        for line in raw.decode().splitlines():
            yield json.loads(line)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 10
    skew_join = (sys.argv[3] if len(sys.argv) > 3 else "on") == "on"
    mode = sys.argv[4] if len(sys.argv) > 4 else "repeat"
    log_dir = tempfile.mkdtemp(prefix="skew-eventlog-", dir="/tmp")
    from pyspark.sql import functions as F

    import hopgraph.session as session
    from hopgraph.functions.scalar import day_bounds
    from hopgraph.plans.recommend import popularity_ranked, recommend
    from hopgraph.plans.edges import incremental_edges
    from hopgraph.sources import testdata as TD

    spark = session.build_session("local[8]", shuffle_partitions=64, extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
        "spark.sql.adaptive.skewJoin.enabled": str(skew_join).lower(),
        # as if the key sets were too large for any broadcast
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    })
    ev = TD.events(spark, sf_dir)
    span = ev.agg(F.max("event_id")).first()[0] + 1
    skewed = (ev.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
                .withColumn("event_id", F.col("event_id") + F.col("copy") * F.lit(span)).drop("copy"))
    if mode == "fanin":
        # events in threes: u1 -> a_k (a new account), a_k -> u0, u0 -> u1; all follows
        skewed = (skewed.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(1))
                                    .when(F.col("event_id") % 3 == 1, F.col("event_id") + F.lit(10))
                                    .otherwise(F.lit(0)))
                        .withColumn("event_type", F.lit("click")))
    else:
        skewed = skewed.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(
            F.col("event_id") if mode == "unique" else F.col("user_id")))
    path = session.fresh_path(spark, "skewed-edges")
    TD.raw_edges_from_events(skewed).write.partitionBy("tbl").parquet(path)
    raw = spark.read.schema(TD.LANDED_EDGE).parquet(path)
    fo, fl = raw.where("tbl = 'followers'").drop("tbl"), raw.where("tbl = 'follows'").drop("tbl")
    hot = "handle" if mode == "fanin" else "actor"
    share = fl.where(f"{hot} = 'u0'").count() / fl.count()
    distinct_share = (fl.where(f"{hot} = 'u0'").select("handle", "actor").distinct().count()
                      / fl.select("handle", "actor").distinct().count())
    interval = day_bounds("2024-01-01", "2024-01-30")
    # the base account: one that follows the hot account, so u0 is in the base set
    base = "u1" if mode == "fanin" else fl.where("handle = 'u0'").agg(F.min("actor")).first()[0]

    def rows(df):
        return sorted(tuple(r) for r in df.collect())

    literal = rows(recommend(fo, fl, "follows_of_follows", base, *interval))
    pop_literal = rows(popularity_ranked(fo, fl, "follows_of_follows", base, *interval))
    spark.sparkContext.setJobGroup("measured", "shuffle tier")
    t = time.perf_counter()
    incremental_edges(fl, *interval).write.format("noop").mode("overwrite").save()
    shuffled = rows(recommend(fo, fl, "follows_of_follows", base, *interval))
    pop_shuffled = rows(popularity_ranked(fo, fl, "follows_of_follows", base, *interval))
    elapsed = time.perf_counter() - t
    spark.stop()

    stages, tasks = {}, {}
    for e in read_events(log_dir):
        if e["Event"] == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            stages[si["Stage ID"]] = si.get("Details", "").split("\n")[0][:70]
        elif e["Event"] == "SparkListenerTaskEnd" and e.get("Task Metrics"):
            sr = e["Task Metrics"].get("Shuffle Read Metrics", {})
            read = sr.get("Remote Bytes Read", 0) + sr.get("Local Bytes Read", 0)
            tasks.setdefault(e["Stage ID"], []).append(read)
    print(f"mode {mode}; skew join {'on' if skew_join else 'off'}; {hot} u0 share of follows: {share:.2%} "
          f"(of distinct edges: {distinct_share:.2%}); base account {base}; "
          f"shuffle-tier results equal literal-tier: {literal == shuffled and pop_literal == pop_shuffled} "
          f"({len(literal)} and {len(pop_literal)} rows; top M12 row {pop_literal[:1]}); "
          f"shuffle-tier run {elapsed:.1f}s")
    worst = []
    for sid, reads in sorted(tasks.items()):
        if sum(reads) == 0 or len(reads) < 4:      # a 2-task stage is not a skew signal
            continue
        worst.append((max(reads) / max(1, statistics.median(reads)), sid, len(reads), max(reads), statistics.median(reads), sum(reads)))
    worst.sort(key=lambda w: w[3] / w[5], reverse=True)
    for ratio, sid, n, mx, med, total in worst[:5]:
        print(f"stage {sid}: {n} tasks, max read {mx/1024:.0f} KiB, median {med/1024:.0f} KiB, "
              f"max/total {mx/total:.1%}  [{stages.get(sid, '')}]")


if __name__ == "__main__":
    main()
