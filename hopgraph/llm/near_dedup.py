"""Operator 5: near-duplicate groups by bottom-k sketches of one hash function.

1. Every document becomes the sorted set of its shingles' hashes; its sketch is
   the ``K`` smallest of them.  Documents with equal sets form one class (the
   smallest id stands for it), so copies are never paired.
2. Inverted lists of the retained values: a pair at the threshold shares at
   least ``overlap_bound`` of its retained values (4 standard deviations below
   the mean; for sets smaller than the sketch the least over all partners).
   So it shares ``t`` of the rarest ``n - bound + t`` values of either side,
   and only those are listed (``t`` is ``SHARED``, or the bound if that is
   less): values of passages that many documents hold never form a list unless
   a document holds little else.  Lists of up to ``LIST`` classes give their
   pairs, and the pairs found ``t`` times over all lists are candidates.  A
   longer list connects its members through the smallest one.  The components
   of these links are the families: a pair that shares fewer listed values, by
   chance, joins nothing.
3. Inside a family, sketch overlaps give the union-sketch estimate of each
   pair, and the full sets confirm the pairs that pass.  A family is one group
   of rows while its sets are under ``BLOCK_SHINGLES`` and its documents under
   ``BLOCK_ROWS``; a larger one is cut into blocks by a hash of the id, and
   every two blocks meet in a group of their own, so a task holds two blocks
   (on average of these sizes) and their square matrices at a time.  A task
   returns only links that join what is not yet joined, at most one per
   document.
4. The links' components are the groups; the smallest id of each stays.

Full sets are rebuilt from the text for family members alone.

Cases: a text that is NULL or has no words has an empty set and no links; a
text of fewer words than a shingle is one shingle; a NULL id stays outside
(component NULL, kept); rows with the same id are one node and share its
component; an empty table gives an empty result; other columns may have any
names.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hopgraph.llm.common import components, table, written
from hopgraph.llm.hashing import shingle_sets, text_chunks

K = 64
SIGMAS = 4.0
SHARED = 8                    # listed values that a pair has to share
LIST = 64                     # classes of a list that gives pairs
BLOCK_SHINGLES = 1 << 20      # hashes of one block: 8 MB
BLOCK_ROWS = 2048             # documents of one block: two blocks meet in matrices of 134 MB
DENSE = 1 << 22               # cells of one incidence matrix


def overlap_bound(n: int, percent: int, k: int = K) -> int:
    """Retained values that a pair at the threshold shares at least, for a sketch of ``n`` values.

    A whole set (``n < k``) shares at least ``s`` values with a partner of
    ``m``, of which the partner's sketch drops ``m - k`` at most: the bound is
    the least over all sizes that a partner can have.
    """
    j = percent / 100
    if n < k:
        sizes = range(-(-n * percent // 100), n * 100 // percent + 1)
        return max(1, min((-(-percent * (n + m) // (100 + percent)) - max(0, m - k) for m in sizes), default=1))
    return max(1, math.floor(k * j - SIGMAS * math.sqrt(k * j * (1 - j))))


def _sets(batch: pa.RecordBatch, n: int) -> Iterator[tuple[int, np.ndarray]]:
    for i, _, data, offsets in text_chunks(batch.column("text")):
        for r, s in enumerate(shingle_sets(data, offsets, n)):
            yield i + r, s


def sketcher(n: int, k: int) -> Callable:
    def sketch(batches):
        for batch in batches:
            sets = [s for _, s in _sets(batch, n)]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                pa.array([s[:k].view(np.int64) for s in sets], pa.list_(pa.int64())),
            ], ["doc_id", "n", "print", "sketch"])
    return sketch


def set_builder(n: int) -> Callable:
    def build(batches):
        for batch in batches:
            part, held = [], 0
            ids = batch.column("doc_id")

            def flush(part=part, ids=ids):
                return pa.RecordBatch.from_arrays([
                    ids.take(pa.array([r for r, _ in part], pa.int64())),
                    pa.array([s.tobytes() for _, s in part], pa.binary())], ["cid", "hashes"])

            for r, s in _sets(batch, n):
                part.append((r, s))
                held += len(s)
                if held > BLOCK_SHINGLES:
                    yield flush()
                    part.clear()
                    held = 0
            if part:
                yield flush()
    return build


def _incidence(owner: np.ndarray, value: np.ndarray, rows: int) -> Iterator[np.ndarray]:
    """Row by value matrices (0/1) over the values that two rows or more hold, some columns at a time."""
    order = np.argsort(value, kind="stable")
    owner, value = owner[order], value[order]
    new = np.ones(len(value), bool)
    np.not_equal(value[1:], value[:-1], out=new[1:])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(value)))
    shared = np.repeat(count > 1, count)
    owner, number = owner[shared], np.repeat(np.arange(int((count > 1).sum())), count[count > 1])
    step = max(64, DENSE // max(1, rows))
    for c in range(0, int(number[-1]) + 1 if len(number) else 0, step):
        a, b = np.searchsorted(number, [c, c + step])
        m = np.zeros((rows, step), np.float32)
        m[owner[a:b], number[a:b] - c] = 1
        yield m


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the pairwise intersections."""
    size = np.array([len(s) for s in sets])
    out = np.zeros((len(sets), len(sets)), np.float64)
    for m in _incidence(np.repeat(np.arange(len(sets)), size), np.concatenate(sets), len(sets)):
        out += m @ m.T
    return out


def estimates(sketches: list[np.ndarray], k: int) -> np.ndarray:
    """Union-sketch estimates of the pairwise similarities.

    Up to the smaller of two sketches' largest values both sets are fully
    known, so shared over distinct values there estimates the similarity; for
    sets smaller than a sketch it is exact.
    """
    limit = np.array([s[-1] if len(s) == k else np.iinfo(np.uint64).max for s in sketches], np.uint64)
    order = np.sort(limit)
    known = np.empty((len(sketches), len(sketches)), np.float64)     # values of i up to limit j
    back = np.searchsorted(order, limit)
    for i, s in enumerate(sketches):
        known[i] = np.searchsorted(s, order, side="right")[back]
    by_i = limit[:, None] <= limit[None, :]
    union = np.where(by_i, np.diag(known)[:, None] + known.T, known + np.diag(known)[None, :])
    shared = _overlaps(sketches)
    return shared / np.maximum(1, union - shared)


def family_links(ids: list[int], sets: list[np.ndarray], percent: int, k: int = K) -> list[tuple[int, int]]:
    """Links of a family that join its documents into groups (a spanning forest of all its links)."""
    if len(ids) < 2:
        return []
    sketches = [s[:k] for s in sets]
    size = np.array([len(s) for s in sets], np.float64)
    slack = SIGMAS * math.sqrt(percent / 100 * (1 - percent / 100) / k)
    small = size < k
    near = estimates(sketches, k) >= np.where(small[:, None] & small[None, :], percent / 100 - 1e-9,
                                              percent / 100 - slack)
    near &= np.minimum(size[:, None], size[None, :]) * 100 >= np.maximum(size[:, None], size[None, :]) * percent
    near = np.triu(near, 1)
    keep = np.flatnonzero(near.any(0) | near.any(1))
    if not len(keep):
        return []
    both = _overlaps([sets[i] for i in keep])
    union = size[keep][:, None] + size[keep][None, :] - both
    link = near[np.ix_(keep, keep)] & (both * 100 >= union * percent)
    parent = list(range(len(keep)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for x, y in zip(*np.nonzero(link), strict=True):
        p, q = root(int(x)), root(int(y))
        if p != q:
            parent[max(p, q)] = min(p, q)
            out.append((ids[keep[x]], ids[keep[y]]))
    return out


def linker(percent: int, k: int) -> Callable:
    """Rows sorted by group (``g``, ``x``, ``y``) to links; a group may run over several batches."""
    def link(batches):
        key, ids, sets = None, [], []

        def done():
            found = family_links(ids, sets, percent, k)
            return pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.int64()),
                                               pa.array([b for _, b in found], pa.int64())], ["a", "b"])

        for batch in batches:
            rows = zip(*[batch.column(c).to_pylist() for c in ("g", "x", "y", "cid", "hashes")], strict=True)
            for g, x, y, cid, raw in rows:
                if (g, x, y) != key:
                    if len(ids) > 1:
                        yield done()
                    key, ids, sets = (g, x, y), [], []
                ids.append(cid)
                sets.append(np.frombuffer(raw, np.uint64))
        if len(ids) > 1:
            yield done()
    return link


def counted_pairs(lists: DataFrame) -> DataFrame:
    """(``a``, ``b``): classes that share as many listed values as both must; every value is held by LIST rows at most.

    ``lists`` has ``v``, ``cid`` and ``t``, the shared values that the class asks for.
    """
    held = lists.groupBy("v").agg(F.sort_array(F.collect_list(F.struct("cid", "t"))).alias("ms"))
    pairs = F.flatten(F.transform("ms", lambda x, i: F.transform(
        F.slice("ms", i + 2, F.size("ms")),
        lambda y: F.struct(x["cid"].alias("a"), y["cid"].alias("b"), F.least(x["t"], y["t"]).alias("t")))))
    return (held.select(F.inline(pairs)).groupBy("a", "b").agg(F.count("*").alias("c"), F.min("t").alias("t"))
            .where("c >= t").select("a", "b"))


def families(classes: DataFrame, percent: int, k: int = K) -> DataFrame:
    """(``cid``, ``g``): classes that share enough listed values, directly or through others."""
    values = classes.select("cid", F.least("n", F.lit(k)).alias("s"), F.explode("sketch").alias("v"))
    often = values.groupBy("v").agg(F.count("*").alias("df")).where("df > 1")
    bounds = F.array(*[F.lit(overlap_bound(i, percent, k)) for i in range(k + 1)])
    # a class's retained values that others hold too, rarest first; those that no one shares are its rarest
    shared = (values.join(often, "v").groupBy("cid", "s")
              .agg(F.sort_array(F.collect_list(F.struct("df", "v"))).alias("vs"))
              .withColumn("bound", F.get(bounds, F.col("s").cast("int")))
              .withColumn("t", F.least("bound", F.lit(SHARED)))
              .withColumn("take", F.size("vs") - F.col("bound") + F.col("t")).where("take > 0"))
    listed = written(shared.select("cid", "t", F.explode(F.slice("vs", F.lit(1), F.col("take"))).alias("e"))
                     .select("cid", "t", F.col("e.v").alias("v")), "nd-lists")
    heads = listed.groupBy("v").agg(F.min("cid").alias("head"), F.count("*").alias("m")).where("m > 1")
    met = listed.join(heads, "v")
    near = counted_pairs(met.where(F.col("m") <= LIST))
    stars = met.where((F.col("m") > LIST) & (F.col("cid") != F.col("head"))).select(
        F.col("cid").alias("a"), F.col("head").alias("b")).distinct()
    return components(near.unionByName(stars)).select(F.col("node").alias("cid"), F.col("component").alias("g"))


def near_groups(docs: DataFrame, n: int = 5, percent: int = 80, k: int = K) -> DataFrame:
    """(``doc_id``, ``n_shingles``, ``component_id``, ``kept``) for every row of ``docs`` (doc_id, text)."""
    docs = docs.select("doc_id", "text")
    prints = written(docs.mapInArrow(sketcher(n, k), "doc_id long, n long, print binary, sketch array<long>"),
                     "nd-sketches", "snappy")
    usable = prints.where("n > 0 AND doc_id IS NOT NULL")
    classes = usable.groupBy("print").agg(F.min("doc_id").alias("cid"), F.max("n").alias("n"),
                                          F.first("sketch").alias("sketch"))
    # one row for each class that stands under its id; an id with several texts keeps the classes apart
    classes = written(classes.select("cid", "n", "sketch", "print"), "nd-classes", "snappy")
    family = written(families(classes, percent, k), "nd-families")
    sizes = (family.join(classes.select("cid", "n"), "cid").groupBy("g")
             .agg(F.greatest(F.ceil(F.sum("n") / BLOCK_SHINGLES), F.ceil(F.count("*") / BLOCK_ROWS))
                  .cast("int").alias("blocks")))
    members = family.join(sizes, "g")
    heads = classes.select("cid", "print").join(members, "cid")
    texts = docs.join(heads.select(F.col("cid").alias("doc_id")).distinct(), "doc_id", "left_semi")
    sets = texts.mapInArrow(set_builder(n), "cid long, hashes binary").join(members, "cid")
    block = F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int")
    meets = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(
        F.least(o, F.col("block")).alias("x"), F.greatest(o, F.col("block")).alias("y")))
    met = (sets.withColumn("block", block).withColumn("m", F.explode(meets))
           .select("g", "m.x", "m.y", "cid", "hashes"))
    links = (met.repartition("g", "x", "y").sortWithinPartitions("g", "x", "y")
             .mapInArrow(linker(percent, k), "a long, b long"))
    member = usable.select("print", "doc_id").join(classes.select("print", "cid"), "print")
    # ids under several texts tie their classes together
    tied = (member.groupBy("doc_id").agg(F.min("cid").alias("a"), F.max("cid").alias("b")).where("a <> b")
            .select("doc_id").join(member, "doc_id").select(F.col("doc_id").alias("a"), F.col("cid").alias("b")))
    groups = written(components(links.unionByName(tied)), "nd-groups")
    labelled = (prints.select("doc_id", "n", "print").join(classes.select("print", "cid"), "print", "left")
                .withColumn("node", F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("cid")))
                .join(groups, "node", "left"))
    own = F.coalesce("component", "node", "doc_id")
    return labelled.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"),
                           (F.col("doc_id").isNull() | (F.col("doc_id") == own)).alias("kept"))


def near_dedup(docs: DataFrame, n: int = 5, percent: int = 80, k: int = K) -> DataFrame:
    """One document of each group, with the columns of ``docs``.

    Of several rows with the id that stays, the one with the smallest text
    stays; rows with a NULL id all stay.
    """
    keep = near_groups(docs, n, percent, k).where("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    packed = docs.select(F.struct("*").alias("_row"), F.col("doc_id").alias("_id"))
    by_id = packed.where("_id IS NOT NULL").join(keep.withColumnRenamed("doc_id", "_id"), "_id", "left_semi")
    first = Window.partitionBy("_id").orderBy("_row.text")
    one = by_id.withColumn("_n", F.row_number().over(first)).where("_n = 1")
    return one.select("_row.*").unionByName(packed.where("_id IS NULL").select("_row.*"))


def op5_near_dedup(spark, sf_dir) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"), n=3, percent=85)
