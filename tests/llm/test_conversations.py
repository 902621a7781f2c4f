"""Conversation repair against a plain search over all edits, on hard rows and the smallest tables."""

import collections
import hashlib
import heapq
import random
import re
import zlib

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hopgraph.llm import conversations as CV

SCHEMA = "conv_id long, turn long, role string, text string"
NONE = hashlib.sha256(b"").hexdigest()


def plain(rows):
    """Dijkstra over (place, state) with whole audit strings as the second key."""
    convs = collections.defaultdict(list)
    for c, t, role, text in rows:
        convs[c]
        role, text = " " if role is None else role, " " if text is None else text
        h = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if h == 0:
            continue
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        role = "user" if h == 4 else role
        convs[c] += [(t, role, text)] * (2 if h == 3 else 1)
    out = []
    for c, got in convs.items():
        got.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
        seen, faults = set(), []
        for _, role, text in got:
            bare = text.strip(" \t\n\x0b\x0c\r")
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen
                          else "truncated" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = {t for t, *_ in got if t is not None}
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(got, got[1:]))
        cost, audit, done = search(got, faults)
        out.append((c, max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count("blank"),
                    faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit,
                    hashlib.sha256("\n".join(f"{r}:{t}" for r, t in done).encode()).hexdigest()))
    return sorted(out, key=repr)


def search(rows, faults):
    follows = {"": "su", "s": "u", "u": "a", "a": "u"}
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, last, made = heapq.heappop(heap)
        if i == len(rows) and last in ("", "a"):
            return cost, audit, made
        if (i, last) in done:
            continue
        done.add((i, last))
        steps = [("I", 2, i, r, "") for r in ("user", "assistant")]
        if i < len(rows):
            _, role, text = rows[i]
            steps.append(("D", 3, i + 1, None, None))
            if faults[i] not in ("blank", "duplicate"):
                cut = faults[i] == "truncated"
                steps += [("K", cut, i + 1, role, text)] + [("R", 2 + cut, i + 1, r, text) for r in ("user", "assistant")]
        for e, price, j, role, text in steps:
            if role is None:
                heapq.heappush(heap, (cost + price, audit + e, j, last, made))
            elif role[:1] and role[:1] in follows[last]:
                heapq.heappush(heap, (cost + price, audit + e, j, role[:1], (*made, (role, text))))
    raise AssertionError


def hard_rows():
    r = random.Random(8)
    texts = ["Yes.", "No!", "cut off", "", "  \t", "Why?", "é…", "same.", "same.", "x.\n", " Oh. "]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", None, "", "sys", "assistant"]
    rows = [(c, t if r.random() < .9 else r.choice([None, t + 3, t - 1]), r.choice(roles), r.choice([*texts, None]))
            for c in range(120) for t in range(r.randint(1, 9))]
    rows += [(None, t, "user", f"t{t}.") for t in range(6)] + [(None, None, None, None)] * 3
    rows += [(900, 5, "user", "tie."), (900, 5, "assistant", "tie."), (900, 5, "user", "other."), (900, 6, "assistant", "z.")]
    rows += [(901, 1, "user", "again.")] * 40 + [(901, 2, "assistant", "again.")]
    rows += [(902, 0, "user", "long " * 50_000 + "."), (902, 1, "assistant", "ok.")]
    rows += [(903, t, r.choice(roles), r.choice(texts) + str(t % 50) + r.choice([".", ""])) for t in range(700)]
    return rows


@pytest.mark.parametrize("step", [1, 64])
def test_repair_equals_a_plain_search(spark, monkeypatch, step):
    """Blocks of any size, conversations over several partitions: the same edits."""
    monkeypatch.setattr(CV, "STEP", step)
    df = spark.createDataFrame(hard_rows(), SCHEMA).repartition(4).select(
        "*", *[F.lit(1).alias(c) for c in ("conv", "digest", "code", "kind", "part", "block", "audit", "fate")])
    got = sorted(map(tuple, CV.repair(df).collect()), key=repr)
    assert got == plain(hard_rows())


def test_repair_of_a_table(spark):
    d = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted(map(tuple, CV.op12_conversation_repair(spark, d).collect()), key=repr) == plain(rows)


def test_repair_of_nothing(spark):
    assert CV.repair(spark.createDataFrame([], SCHEMA)).collect() == []
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    assert [tuple(r) for r in CV.repair(spark.createDataFrame([(gone, 0, "user", "x.")], SCHEMA)).collect()] == [
        (gone, 0, 0, 0, 0, 0, 0, "", NONE)]


def test_block_costs_meet_the_whole():
    """Cost tables of two halves, put together, are those of the whole."""
    r = random.Random(4)
    for _ in range(200):
        codes = bytes(r.randrange(9) for _ in range(r.randint(2, 30)))
        at = r.randint(1, len(codes) - 1)
        x, y, z = CV.cost_table(codes[:at]), CV.cost_table(codes[at:]), CV.cost_table(codes)
        for p in range(4):
            for q in range(4):
                both = min(x[4 * p + m] + y[4 * m + q] for m in range(4))
                assert both == z[4 * p + q] or min(both, z[4 * p + q]) >= CV.NEVER


def test_sql_states_the_same_repair():
    rows = [r for r in hard_rows() if r[0] != 903]
    con = duckdb.connect()
    con.register("conversations", pa.table({c: pa.array([r[i] for r in rows], t) for i, (c, t) in enumerate(
        [("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])}))
    assert sorted(con.execute(CV.SQL).fetchall(), key=repr) == plain(rows)
