"""Spelling variants and exact deduplication against plain Python and SQL on small, hard tables."""

import collections
import random
import re
import zlib

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hopgraph.llm import exact_dedup as ED, spelling as SP

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ALPHABET = [chr(c) for c in [*range(97, 123), *range(65, 91), *range(0xC0, 0x100)]]


def doc_rows():
    r = random.Random(12)
    stems = ["".join(r.choice("abcdeéß÷") for _ in range(r.randint(6, 9))) for _ in range(30)]

    def typo(w):
        i = r.randrange(len(w))
        return r.choice([w[:i] + w[i + 1:], w[:i] + r.choice("abé") + w[i:], w[:i] + r.choice("xyÀ") + w[i + 1:]])

    rows = [(i, " ".join(typo(w) if r.random() < .1 else w.upper() if r.random() < .1 else w
                         for w in r.choices(stems, k=60)), "en", "a", 0) for i in range(60)]
    long = "q" * 3000
    rows += [(70, None, None, None, None), (71, "", "en", "a", 0), (71, "", "en", "a", 0), (None, " ".join(stems), "en", "b", 0),
             (None, None, "en", "b", 0), (72, f"{long} {long} {long}r {long}r aaaaaaaa aaaaaaaa aaaaaaa aaaaaaa", "x", "y", 0),
             (73, "Straße1naïveté_NAÏVETÉ ÀÉÎÕÜÝÞß×÷ÿ àéîõüýþß×÷ÿ", "fr", "z", 0)] + [(80, rows[0][1], "en", "a", 0)] * 3
    return rows


def plain_spelling(rows):
    n = collections.Counter()
    for i, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            n[run] += 1
    n = {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    out = {}
    for w, k in n.items():
        around = [v for v in n if near(w, v)]
        top = min(around, key=lambda v: (-n[v], v), default=None)
        out[w] = (k, len(around), top if top and n[top] >= 10 * k else None)
    rows = []
    for w, (k, m, form) in out.items():
        root = w
        while out[root][2]:
            root = out[root][2]
        rows.append((w, k, m, form, n[form] if form else None, root))
    return sorted(rows, key=repr)


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(doc_rows(), SCHEMA).repartition(5).select(
        "*", *[F.lit("x").alias(c) for c in ("word", "n", "class", "digest", "rid", "content", "hot", "salt")]
    ).write.parquet(f"{d}/documents.parquet")
    return d


def duck(sql):
    con = duckdb.connect()
    con.register("documents", pa.table({c: pa.array([r[i] for r in doc_rows()], t) for i, (c, t) in enumerate(
        [("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string())])}))
    return sorted(con.execute(sql).fetchall(), key=repr)


def test_spelling_equals_plain_python_and_sql(spark, sf):
    want = plain_spelling(doc_rows())
    assert sum(r[3] is not None for r in want) > 20
    assert sorted(map(tuple, SP.op11_spelling(spark, sf).collect()), key=repr) == want
    short = [tuple(r) for r in duck(SP.SQL)]
    assert short == want


def test_spelling_in_many_shards_and_rounds(spark, sf):
    """Filters of a few words each, broadcast two shards at a time, give the same links."""
    words = SP.words_of_documents(spark.read.parquet(f"{sf}/documents.parquet"))
    got = SP.spelling_variants(words, words_per_shard=7, round_bytes=64)
    assert sorted(map(tuple, got.select("word", "n", "n_near", "form", "form_n", "root").collect()),
                  key=repr) == plain_spelling(doc_rows())


def test_spelling_of_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert SP.spelling_variants(SP.words_of_documents(empty)).collect() == []


def test_chains_of_forms_reach_their_root(spark):
    counts = {"abcdefg": 2, "abcdefh": 20, "abcdeih": 200, "abcdejh": 200, "abckejh": 2000, "zzzzzzz": 5}
    words = spark.createDataFrame([(w,) for w, n in counts.items() for _ in range(n)], "word string")
    got = {r.word: (r.form, r.root, r.n_near) for r in SP.spelling_variants(words).collect()}
    assert got["abcdefg"] == ("abcdefh", "abcdeih", 1)
    assert got["abcdefh"] == ("abcdeih", "abcdeih", 3)            # equal counts: the smaller word
    assert got["abcdejh"][:2] == ("abckejh", "abckejh") and got["zzzzzzz"] == (None, "zzzzzzz", 0)


def test_bloom_filters_hold_what_they_were_given():
    import numpy as np
    h = SP.mixed(np.arange(200_000, dtype=np.uint64))
    lanes = SP.bloom_filter(h[:100_000])
    assert SP.bloom_has(lanes, h[:100_000]).all()
    assert SP.bloom_has(lanes, h[100_000:]).mean() < 0.002


def plain_exact(rows):
    groups = collections.defaultdict(list)
    for i, r in enumerate(rows):
        groups[r[1] or ""].append((r[0] is not None, r[0] or 0, i))
    top = {t: max(g) for t, g in groups.items()}
    import hashlib
    return sorted(((r[0], rows[top[r[1] or ""][2]][0], len(groups[r[1] or ""]), top[r[1] or ""][2] == i,
                    hashlib.sha256((r[1] or "").encode()).hexdigest()) for i, r in enumerate(rows)), key=repr)


def test_exact_dedup_equals_plain_python_and_sql(spark, sf):
    want = plain_exact(doc_rows())
    assert sorted(map(tuple, ED.op13_exact_dedup(spark, sf).collect()), key=repr) == want
    assert duck(ED.SQL) == want


def test_exact_dedup_compares_whole_texts_when_digests_collide(spark):
    """A digest of three values for all texts, hot and cold ones alike."""
    rows = [(i, f"t{i % 37}" if i % 3 else "hot", "en", "a", 0) for i in range(300)] + [(None, None, "", "", 0)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(7).withColumn("rid", F.monotonically_increasing_id())
    got = ED.mark_copies(df, lambda c: F.substring(F.sha2(c.cast("binary"), 256), 1, 1) <= "4")
    want = [r[:4] for r in plain_exact(rows)]
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in got.collect()), key=repr) == sorted(want, key=repr)


def test_exact_dedup_keeps_rows_whole(spark):
    rows = [(1, "a", "en", "s", 1), (2, "a", "de", "t", 1), (2, "a", "de", "t", 1), (3, None, "x", "y", 0), (4, "", "x", "z", 0)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("rid", F.lit("own")).withColumn("_row", F.lit(7))
    out = ED.exact_dedup(df)
    assert out.columns == df.columns
    assert sorted(map(tuple, out.collect())) == [(2, "a", "de", "t", 1, "own", 7), (4, "", "x", "z", 0, "own", 7)]
    assert ED.exact_dedup(spark.createDataFrame([], SCHEMA)).collect() == []
