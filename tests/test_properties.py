"""Random small graphs: the Spark models against a brute-force Python model."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from hopgraph.plans.edges import dim_profiles, dim_profiles_tagged, incremental_edges
from hopgraph.plans.recommend import VARIANTS, popularity_ranked, recommend
from hopgraph.schemas import RAW_EDGE

ACCOUNTS = ["me", "a", "b", "c", "d"]
T0 = dt.datetime(2024, 3, 1)
START, END = dt.datetime(2024, 3, 1), dt.datetime(2024, 3, 1, 0, 0, 40)
BASE = "me"

edge = st.tuples(
    st.sampled_from(["followers", "follows"]),
    st.sampled_from(ACCOUNTS),                                  # actor
    st.one_of(st.sampled_from(ACCOUNTS), st.none()),            # handle (NULL sometimes)
    st.sampled_from(["", "Old", "New"]),                        # display name
    st.integers(0, 50),                                         # load second (some outside range)
)


def load_time(sec):
    return T0 + dt.timedelta(seconds=sec)


def to_raw(spark, rows, table):
    data = []
    for i, (tbl, actor, handle, name, sec) in enumerate(rows):
        if tbl != table:
            continue
        did = None if handle is None else f"did:{handle}"
        epoch = (load_time(sec) - dt.datetime(1970, 1, 1)).total_seconds()
        data.append((did, handle, name, None, T0, None, T0, actor, f"{int(epoch)}.000000",
                     f"r{i:03d}", None, None))
    return spark.createDataFrame(data, RAW_EDGE)


def latest(rows, table):
    best = {}
    for i, (tbl, actor, handle, name, sec) in enumerate(rows):
        if tbl != table or not (START <= load_time(sec) <= END):
            continue
        rank = (load_time(sec), f"r{i:03d}")
        key = (handle, actor)
        if key not in best or rank > best[key][0]:
            best[key] = (rank, {"actor": actor, "handle": handle, "name": name,
                                "did": None if handle is None else f"did:{handle}", "rank": rank})
    return [v[1] for v in best.values()]


def brute(rows, variant):
    cand, base_t, excl_t = VARIANTS[variant]
    base = {r["handle"] for r in latest(rows, base_t) if r["actor"] == BASE}
    excl = {r["handle"] for r in latest(rows, excl_t) if r["actor"] == BASE}
    hop = [r for r in latest(rows, cand) if r["actor"] is not None and r["actor"] in base]

    def not_in(h):
        if not excl:
            return True
        return h is not None and None not in excl and h not in excl

    kept = [r for r in hop if not_in(r["handle"])]
    literal = {(r["handle"], r["did"], r["name"], 1) for r in kept}
    groups = {}
    for r in kept:
        g = groups.setdefault((r["handle"], r["did"]), {"actors": set(), "newest": None})
        g["actors"].add(r["actor"])
        key = (r["rank"], r["name"])
        g["newest"] = max(g["newest"], key) if g["newest"] else key
    pop = {(h, d, g["newest"][1], len(g["actors"])) for (h, d), g in groups.items()}
    return literal, pop


def rows_of(df):
    return {(r["handle"], r["did"], r["display_name"], r["follower_count"]) for r in df.collect()}


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(edge, min_size=0, max_size=14), variant=st.sampled_from(sorted(VARIANTS)))
def test_rankings_match_brute_force(spark, rows, variant):
    fo, fl = to_raw(spark, rows, "followers"), to_raw(spark, rows, "follows")
    literal, pop = brute(rows, variant)
    assert rows_of(recommend(fo, fl, variant, BASE, START, END)) == literal
    assert rows_of(popularity_ranked(fo, fl, variant, BASE, START, END)) == pop


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(edge, min_size=0, max_size=14))
def test_latest_and_dim_match_brute_force(spark, rows):
    fo, fl = to_raw(spark, rows, "followers"), to_raw(spark, rows, "follows")
    lf, ll = incremental_edges(fo, START, END), incremental_edges(fl, START, END)
    got = {(r["handle"], r["actor"], r["display_name"]) for r in ll.collect()}
    assert got == {(r["handle"], r["actor"], r["name"]) for r in latest(rows, "follows")}
    dims = {(r["did"], r["handle"], r["display_name"]) for r in dim_profiles(lf, ll).collect()}
    want = {(r["did"], r["handle"], r["name"]) for t in ("followers", "follows") for r in latest(rows, t)}
    assert dims == want
    both = fo.withColumn("tbl", F.lit("followers")).unionByName(fl.withColumn("tbl", F.lit("follows")))
    tagged = {(r["did"], r["handle"], r["display_name"]) for r in dim_profiles_tagged(both, START, END).collect()}
    assert tagged == want


upsert_row = st.tuples(st.one_of(st.sampled_from(["h1", "h2", "h3", "h4"]), st.none()),
                       st.sampled_from(["a", "b"]), st.integers(0, 9))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(batches=st.lists(st.lists(upsert_row, min_size=0, max_size=6, unique_by=lambda r: (r[0], r[1])),
                        min_size=1, max_size=3))
def test_stored_and_plain_upserts_match_brute_force(spark, batches):
    import uuid
    from hopgraph.plans import stored as ST
    from hopgraph.plans.materialize import upsert_by_key
    schema, keys = "handle string, actor string, v int", ["handle", "actor"]
    plain = spark.createDataFrame([], schema)
    table = f"p_{uuid.uuid4().hex[:8]}"
    stored = ST.store(plain, f"{table}_0", keys, 3)
    model: list[tuple] = []
    for n, batch in enumerate(batches):
        df = spark.createDataFrame(batch, schema)
        stored = ST.upsert(f"{table}_{n}", df, keys, f"{table}_{n + 1}", 3)
        plain = upsert_by_key(plain, df, keys)
        taken = {(h, a) for h, a, _ in batch if h is not None}
        # NULL keys never match, so they are never replaced
        model = [r for r in model if r[0] is None or (r[0], r[1]) not in taken] + list(batch)
    want = sorted(model, key=repr)
    assert sorted((tuple(r) for r in stored.collect()), key=repr) == want
    assert sorted((tuple(r) for r in plain.collect()), key=repr) == want


named_edge = st.tuples(st.sampled_from(["followers", "follows"]), st.sampled_from(["me", "a", "b", "c"]),
                       st.sampled_from(["me", "a", "b", "c", "d"]), st.sampled_from(["", "Old", "New"]), st.integers(0, 40))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(batches=st.lists(st.lists(named_edge, max_size=9), min_size=2, max_size=3), variant=st.sampled_from(sorted(VARIANTS)))
def test_rankings_kept_by_deltas_equal_a_rebuild(spark, batches, variant):
    """Any split into batches, edges and base set changing together: the maintained views equal full queries."""
    from hopgraph.plans import maintained as MT
    from hopgraph.plans.materialize import upsert_by_key
    from hopgraph.plans.recommend import popularity_stored, recommend_stored
    from hopgraph.schemas import EDGE_KEY
    from hopgraph.session import written
    cand, base, excl = VARIANTS[variant]
    near = lambda e, t: e[t].where(F.col("actor") == BASE).select("handle").distinct()
    none = incremental_edges(to_raw(spark, [], "follows"), START, END)
    edges = {"followers": none, "follows": none}
    ranking = MT.ranking_of(edges[cand], near(edges, base))
    for n, rows in enumerate(batches):
        batch = {t: written(incremental_edges(to_raw(spark, rows, t), START, END), f"b{n}") for t in edges}
        after = {t: written(upsert_by_key(edges[t], batch[t], EDGE_KEY), f"e{n}") for t in edges}
        hop = MT.hop_changes(MT.edge_changes(edges[cand], batch[cand]), edges[cand], near(edges, base), near(after, base))
        ranking = written(MT.apply_changes(ranking, hop, after[cand], near(after, base)), f"r{n}")
        edges = after
    rebuilt = MT.ranking_of(edges[cand], near(edges, base))
    assert sorted(map(tuple, ranking.collect()), key=repr) == sorted(map(tuple, rebuilt.collect()), key=repr)
    exclude = near(edges, excl)
    assert rows_of(MT.literal(ranking, exclude)) == rows_of(recommend_stored(edges["followers"], edges["follows"], variant, BASE))
    assert rows_of(MT.popularity(ranking, exclude)) == rows_of(popularity_stored(edges["followers"], edges["follows"], variant, BASE))


reload_step = st.tuples(
    st.sets(st.integers(0, 11), max_size=12),          # which source rows exist in this version
    st.integers(0, 5 * 60), st.integers(0, 5 * 60),    # interval bounds, minutes after T0
)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(steps=st.lists(reload_step, min_size=1, max_size=3))
def test_interval_reloads_match_brute_force(spark, steps):
    import uuid
    from hopgraph.plans.materialize import HourlyTable, overwrite_interval
    times = [T0 + dt.timedelta(minutes=25 * i) for i in range(12)]       # spread over 5 hours
    hourly = HourlyTable(spark, f"r_{uuid.uuid4().hex[:8]}", "t")
    generic = spark.createDataFrame([], "k string, t timestamp_ntz")
    model_g: set = set()
    model_h: set = set()
    for present, a, b in steps:
        lo, hi = sorted((T0 + dt.timedelta(minutes=a), T0 + dt.timedelta(minutes=b)))
        rows = [(f"r{i}", times[i]) for i in sorted(present)]
        src = spark.createDataFrame(rows, "k string, t timestamp_ntz")

        def build(x, y, src=src):
            return src.where(F.col("t").between(F.lit(x), F.lit(y)))

        generic = overwrite_interval(generic, src, "t", lo, hi)
        hourly.reload(build, lo, hi)
        wlo, whi = HourlyTable.hour_bounds(lo, hi)
        model_g = {r for r in model_g if not lo <= r[1] <= hi} | {r for r in rows if lo <= r[1] <= hi}
        model_h = {r for r in model_h if not wlo <= r[1] <= whi} | {r for r in rows if wlo <= r[1] <= whi}
    assert {tuple(r) for r in generic.collect()} == model_g
    assert {tuple(r) for r in hourly.read().collect()} == model_h
