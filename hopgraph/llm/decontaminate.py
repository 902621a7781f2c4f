"""Operator 6: benchmark decontamination by spaced-seed hashing.

Tokens are runs of letters and digits, lower-cased (A-Z).  Fixed masks over a
span of tokens hash some positions and ignore the others, so a hit survives
substitutions at the ignored places.  Seed hashes of the test items are joined
to those of the documents; every pair that shares one is laid over each other
on the diagonals of all its hits, and the best stretch (a match scores 1, a
substitution -2) decides.  A document holds an item if that stretch matches at
least ``MIN_MATCH`` tokens, or ``WHOLE_PCT`` percent of the item where that is
fewer, with ``IDENTITY_PCT`` percent of its tokens equal.

Equal items and equal documents are worked on once, by the SHA-256 of their
text, and joined back to their ids at the end.  Only a Bloom filter of the
items' seeds is broadcast, at most ``FILTER_BITS`` bits however large the
benchmark is; it lets nearly all documents without a hit leave the map side
without a row.  Seeds,
pairs and texts of the others meet in joins, which Spark broadcasts only by
the measured size of a written table and splits where a key is hot.

Cases: a NULL or empty text, or one shorter than a seed, holds nothing; items
of under ``MIN_TOKENS`` tokens are too short to tell and match nothing, items
between that and the span are sought as one unbroken seed; repeated items and
rows each give their own hits; no items or no documents give an empty result.
A text of one repeated token is no special case: the diagonals of a seed with
many places come from one correlation instead of from all pairs of places.
"""

from __future__ import annotations

import hashlib
from collections import OrderedDict
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hopgraph.llm.common import table, written
from hopgraph.llm.hashing import PUNCTUATION, gram_hashes, text_chunks, word_hashes

#: (span, hashed positions): weight 6 of 9, 10 and 11 places
MASKS = ((9, (0, 1, 3, 4, 6, 8)), (10, (0, 2, 3, 5, 8, 9)), (11, (0, 1, 4, 6, 9, 10)), (6, (0, 1, 2, 3, 4, 5)))
MIN_TOKENS = 6
MIN_MATCH = 13
WHOLE_PCT = 70
IDENTITY_PCT = 75
FILTER_BITS = 1 << 28        # 32 MB at most
BITS_EACH = 128              # bits for each distinct seed, up to that
PROBES = 6
PIECE_BITS = 1 << 19         # one group of the filter's aggregate
MANY = 1 << 20               # pairs of places of one hash taken at once
CACHE_TOKENS = 1 << 21       # tokens of items that a task keeps hashed

PAIR = "key binary, item_key binary, n_match long, n_span long, at_token long, n_item_tokens long"


def tokens_of(text: str) -> np.ndarray:
    """Token hashes of one text."""
    data = np.frombuffer(text.encode(), np.uint8)
    return word_hashes(data, np.array([0, len(data)]), PUNCTUATION)[0]


def seeds_of(tokens: np.ndarray) -> list[np.ndarray]:
    """Seed hashes at every place, one array a mask."""
    return [gram_hashes(tokens, span, places) for span, places in MASKS]


class Item:
    """A test item's tokens, and its seeds in hash order."""

    def __init__(self, text: str):
        self.tokens = tokens_of(text)
        seeds = seeds_of(self.tokens) if len(self.tokens) >= MIN_TOKENS else [np.zeros(0, np.uint64)] * len(MASKS)
        self.order = [np.argsort(h, kind="stable") for h in seeds]
        self.seeds = [h[o] for h, o in zip(seeds, self.order, strict=True)]


def diagonals(seeds: list[np.ndarray], item: Item, n_tokens: int) -> np.ndarray:
    """Sorted distinct diagonals (document place - item place) of all seed hits."""
    m = len(item.tokens)
    mark = np.zeros(n_tokens + m + 1, bool)                   # diagonal + m
    for mine, theirs, order in zip(seeds, item.seeds, item.order, strict=True):
        a, b = np.searchsorted(theirs, mine, "left"), np.searchsorted(theirs, mine, "right")
        places = np.flatnonzero(b > a)
        if not len(places):
            continue
        first, inverse, count = np.unique(a[places], return_inverse=True, return_counts=True)
        width = (b - a)[places]
        hot = (count[inverse] * width) > MANY
        for k in np.unique(inverse[hot]):                     # a hash with many places on both sides
            p, q = places[inverse == k], order[first[k]:first[k] + width[inverse == k][0]]
            size = 1 << int(n_tokens + m).bit_length()
            x, y = np.zeros(size), np.zeros(size)
            x[p], y[m - q] = 1, 1
            mark |= np.fft.irfft(np.fft.rfft(x) * np.fft.rfft(y), size)[:len(mark)] > 0.5
        places, width = places[~hot], width[~hot]
        start = a[places]
        total = np.cumsum(width)
        cut = [0, *np.searchsorted(total, np.arange(MANY, total[-1], MANY)), len(places)] if len(places) else []
        for i, j in zip(cut[:-1], cut[1:], strict=True):
            n = width[i:j]
            k = np.repeat(start[i:j] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            mark[np.repeat(places[i:j], n) - order[k] + m] = True
    return np.flatnonzero(mark) - m


def best_stretch(tokens: np.ndarray, seeds: list[np.ndarray], item: Item) -> tuple[int, int, int] | None:
    """(matches, length, document place) of the best verified stretch, or None.

    Diagonals come by the length of their overlap; none shorter than the best
    number of matches so far can be better.
    """
    size, best = len(item.tokens), None
    need = min(MIN_MATCH, -(-size * WHOLE_PCT // 100))
    d = diagonals(seeds, item, len(tokens))
    a, b = np.maximum(0, d), np.minimum(len(tokens), d + size)
    for k in np.argsort(a - b, kind="stable"):
        if b[k] - a[k] < (need if best is None else best[0]):
            break
        equal = tokens[a[k]:b[k]] == item.tokens[a[k] - d[k]:b[k] - d[k]]
        run = np.concatenate([[0], np.cumsum(np.where(equal, 1, -2))])
        end = int((run - np.minimum.accumulate(run)).argmax())
        start = int(run[:end + 1].argmin()) if end else 0
        m, n = int(equal[start:end].sum()), end - start
        if m >= need and m * 100 >= n * IDENTITY_PCT:
            best = max(best or (0, 0, 0), (m, -n, -int(a[k] + start)))
            if best[0] == -best[1] == b[k] - a[k]:            # a whole overlap: later ones lie behind it or are shorter
                break
    return best and (best[0], -best[1], -best[2])


def _item_seeds(batches):
    for batch in batches:
        for key, text in zip(batch.column("item_key"), batch.column("item_text").to_pylist(), strict=True):
            h = np.unique(np.concatenate(Item(text).seeds)).view(np.int64)
            for i in range(0, len(h), MANY):
                part = pa.array(h[i:i + MANY])
                yield pa.RecordBatch.from_arrays([pa.repeat(key, len(part)), part], ["item_key", "h"])


def _piece(bits: int) -> Callable:
    def build(key, rows):
        out = np.zeros(bits >> 3, np.uint8)
        at = rows["bit"].to_numpy()
        np.bitwise_or.at(out, at >> 3, (1 << (at & 7)).astype(np.uint8))
        return pd.DataFrame({"piece": [key[0]], "bits": [out.tobytes()]})
    return build


def seed_filter(seeds: DataFrame) -> np.ndarray:
    """Bloom filter of all seed hashes (``PROBES`` places each), of ``FILTER_BITS`` bits at most."""
    n = seeds.select("h").distinct().count()
    size = min(FILTER_BITS, max(PIECE_BITS, 1 << (BITS_EACH * n).bit_length()))
    low, step = F.col("h").bitwiseAND(F.lit((1 << 32) - 1)), F.shiftrightunsigned("h", 32).bitwiseOR(F.lit(1))
    at = F.explode(F.array(*[(low + step * F.lit(j)).bitwiseAND(F.lit(size - 1)) for j in range(PROBES)]))
    pieces = (seeds.select("h").distinct().select(at.alias("at")).distinct()
              .select(F.shiftright("at", PIECE_BITS.bit_length() - 1).alias("piece"),
                      F.col("at").bitwiseAND(F.lit(PIECE_BITS - 1)).alias("bit"))
              .groupBy("piece").applyInPandas(_piece(PIECE_BITS), "piece long, bits binary"))
    out = np.zeros(size >> 3, np.uint8)
    width = PIECE_BITS >> 3
    for r in pieces.collect():                                # 64 KB each, 512 at most
        out[r["piece"] * width:(r["piece"] + 1) * width] = np.frombuffer(r["bits"], np.uint8)
    return out


def probed(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    """The places of ``h`` whose hashes the filter may hold."""
    i = np.arange(len(h))
    for j in range(PROBES):
        at = ((h & np.uint64((1 << 32) - 1)) + np.uint64(j) * (h >> np.uint64(32) | np.uint64(1))) & np.uint64(len(bits) * 8 - 1)
        keep = (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
        i, h = i[keep], h[keep]
    return i


def _candidates(shared) -> Callable:
    def search(batches):
        bits = shared.value
        for batch in batches:
            for row, _, data, offsets in text_chunks(batch.column("text")):
                tokens, doc = word_hashes(data, offsets, PUNCTUATION)
                found = []
                for span, places in MASKS:
                    h = gram_hashes(tokens, span, places)
                    i = probed(bits, h)
                    i = i[doc[i] == doc[i + span - 1]]
                    found.append(np.stack([doc[i], h[i].view(np.int64)], 1))
                rows = np.unique(np.concatenate(found), axis=0)
                if not len(rows):
                    continue
                hit, first = np.unique(rows[:, 0], return_index=True)
                at = pa.array(row + hit)
                keys = [hashlib.sha256(data[offsets[i]:offsets[i + 1]]).digest() for i in hit.tolist()]
                lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(rows)), pa.int32()), pa.array(rows[:, 1]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(at), pa.array(keys, pa.binary()), batch.column("text").take(at), lists],
                    ["doc_id", "key", "text", "hashes"])
    return search


def _verified(batches):
    items: OrderedDict[bytes, Item] = OrderedDict()
    held, last, tokens, seeds = 0, None, None, None
    for batch in batches:
        rows = []
        for i, (key, item_key) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("key", "item_key")), strict=True)):
            if key != last:
                last, tokens = key, tokens_of(batch.column("text")[i].as_py())
                seeds = seeds_of(tokens)
            item = items.pop(item_key, None)
            if item is None:
                item = Item(batch.column("item_text")[i].as_py())
                held += len(item.tokens)
            items[item_key] = item
            while held > CACHE_TOKENS and len(items) > 1:
                held -= len(items.popitem(last=False)[1].tokens)
            best = best_stretch(tokens, seeds, item)
            if best:
                rows.append((key, item_key, *best, len(item.tokens)))
        columns = list(zip(*rows, strict=True)) or [()] * 6
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.binary() if k < 2 else pa.int64()) for k, c in enumerate(columns)],
            ["key", "item_key", "n_match", "n_span", "at_token", "n_item_tokens"])


def _digest(text):
    return F.unhex(F.sha2(text, 256))


def _matches(docs: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Candidate documents (doc_id, key) and the verified pairs of distinct texts (``PAIR``)."""
    sc = docs.sparkSession.sparkContext
    texts = written(items.groupBy("item_key").agg(F.first("item_text").alias("item_text")), "decon-items")
    seeds = written(texts.mapInArrow(_item_seeds, "item_key binary, h long"), "decon-seeds")
    doc_type = docs.schema["doc_id"].dataType.simpleString()
    hits = written(docs.select("doc_id", "text").mapInArrow(
        _candidates(sc.broadcast(seed_filter(seeds))),
        f"doc_id {doc_type}, key binary, text string, hashes array<long>"), "decon-hits")
    pairs = written(hits.select("key", F.explode("hashes").alias("h")).distinct().join(seeds, "h")
                    .select("key", "item_key").distinct(), "decon-pairs")
    bodies = (hits.join(pairs.select("key").distinct(), "key", "left_semi")
              .groupBy("key").agg(F.first("text").alias("text")))
    checked = pairs.join(texts, "item_key").join(bodies, "key").select("key", "text", "item_key", "item_text")
    return hits.select("doc_id", "key"), written(checked.mapInArrow(_verified, PAIR), "decon-checked")


def _items(benchmark: DataFrame) -> DataFrame:
    return benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("item_text")).withColumn(
        "item_key", _digest("item_text"))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document and test item it holds (doc_id, item_id, n_match, n_span, at_token, ...)."""
    items = _items(benchmark)
    hits, checked = _matches(docs, items)
    return (hits.join(checked, "key").join(items.select("item_id", "item_key"), "item_key")
            .select("doc_id", "item_id", "n_match", "n_span", "at_token", "n_item_tokens"))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no test item, with the columns of ``docs``.

    The digests of the texts to drop are joined by their measured size: under
    Spark's broadcast threshold no document is shuffled.
    """
    _, checked = _matches(docs, _items(benchmark))
    rows = docs.select(F.struct("*").alias("_row"), _digest(F.coalesce("text", F.lit(""))).alias("_key"))
    return rows.join(checked.select(F.col("key").alias("_key")).distinct(), "_key", "left_anti").select("_row.*")


def op6_decontamination(spark, sf_dir) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
