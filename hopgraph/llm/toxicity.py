"""Operator 9: toxicity by class-conditional Kneser-Ney models with shared backoff.

Two models, one of the toxic and one of the ordinary training texts, give
every word a probability after the word before it.  Both are class-based
bigrams: ``P(w | v) = P(k(w) | k(v)) * P(w | k(w))``, the class of a word
being its first two bytes, so that words keep their history.  Full word
bigrams would need several times the input of disk (15 million of them in a
0.1 GB table), which no limit here allows.

* *History*: ``P(k | h)`` discounts the bigram counts of the class and backs
  off to ``P(k)``, which discounts the class's own counts and backs off to the
  number of different histories that ``k`` has been seen after, in both models'
  texts together.
* *Word*: ``P(w | k)`` runs down the prefixes of four and six bytes to the word.
  At each step the counts within the prefix above are discounted; the mass set
  free goes to shares that both models have in common: how many different
  continuations a prefix has, and at the word its pooled count.

Discounts come from the counts themselves (n1 / (n1 + 2 n2), by level and
model); ``PRIOR`` events of the shared distribution are added to every context.
A count is of documents: a word after the same history counts once in a text.
What neither model has seen takes the ratio of its longest known prefix, so an
expression that neither class knows moves nothing, and a rare one leans on its
prefixes.

A document's evidence is length-normalised: the mean log-likelihood ratio of
its words, the largest mean of ``WINDOW`` words in a row, and the mean of its
``TOP`` largest words.  A logistic regression turns the evidence into a score;
it is fitted on at most ``FIT_ROWS`` training documents, each scored by the
counts of the other half of the training rows.

The counts cover every training row.  The table of ratios holds exact (64-bit)
keys, lies in the shared folder and grows with the corpus; nothing of it is
broadcast.  Texts are packed once, in groups of about ``GROUP_BYTES``, into a
table bucketed by group, and do not move again: labels come to the groups by
id, the distinct keys of each group are joined to the table of ratios, and the
known ones return to their group.

Cases: NULL and empty texts have no evidence and get the model's base score;
labels are joined by id (the largest label of an id counts); rows with a NULL
id are scored, never learnt from; without labels of both classes every score
is 0; repeated rows count again; a very long text is a group of its own; an
empty table gives an empty result; other columns may have any names.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hopgraph.llm.common import table, written
from hopgraph.llm.fitting import Logistic
from hopgraph.llm.hashing import _LOWER, PUNCTUATION, mixed, span_hashes, text_chunks, word_spans
from hopgraph.plans.stored import qualified

MODELS = {"a": ((0,), (1,)), "b": ((2,), (3,)), "f": ((0, 2), (1, 3))}     # classes: ordinary, toxic
PRIOR = 20.0
WINDOW = 10
TOP = 5
FIT_ROWS = 6_000
GROUP_BYTES = 32 << 20
SUM_ROWS = 400_000
THRESHOLD = 0.7
HELD_OUT = 1               # crc32(doc_id) mod 3
#: keys of the levels are numbers of their bytes under a tag: four bytes, six, class bigram, class; words are hashes below zero
FOUR, SIX, PAIR, CLASS = (i << 56 for i in (1, 2, 3, 4))
FEATURES = 4


def fold_of(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)).cast("int")


# ------------------------------------------------------------------ words as keys


def keys(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]:
    """(document number, keys of [four bytes, six bytes, word, class bigram, class], first six bytes, class before).

    Six bytes are one number (shorter words end in zeros, which no word holds); their first four and their
    class are that number shifted right.
    """
    s, e, doc = word_spans(data, offsets, PUNCTUATION)
    if not len(s):
        z = np.zeros(0, np.uint64)
        return doc, [z] * 5, z, np.zeros(0, np.int32)
    low = _LOWER[data].astype(np.uint64)
    six = np.zeros(len(s), np.uint64)
    for i in range(6):
        six = (six << np.uint64(8)) | np.where(e - s > i, low[np.minimum(s + i, len(data) - 1)], np.uint64(0))
    four, k = six >> np.uint64(16), six >> np.uint64(32)
    h = np.concatenate([np.zeros(1, np.uint64), k[:-1]])
    h[np.concatenate([[True], doc[1:] != doc[:-1]])] = 0             # a text's first word has no history
    word = span_hashes(data, [(s, e)])[0] | np.uint64(1 << 63)
    pair = (h << np.uint64(16)) | k
    tagged = [x | np.uint64(tag) for x, tag in ((four, FOUR), (six, SIX), (pair, PAIR), (k, CLASS))]
    return doc, [*tagged[:2], word, *tagged[2:]], six, h.astype(np.int32)


def _firsts(*columns: np.ndarray) -> np.ndarray:
    """Places of the first of each distinct tuple, by one mixed key."""
    key = np.zeros(len(columns[0]), np.uint64)
    for c in columns:
        key = mixed(key ^ c.astype(np.uint64)) + np.uint64(1)
    return np.unique(key, return_index=True)[1]


COUNT_COLUMNS = ["key", "six", "h", "c0", "c1", "c2", "c3"]


def _summed(parts: list[list[np.ndarray]]) -> list[np.ndarray]:
    """Count rows added up by key."""
    columns = [np.concatenate(c) for c in zip(*parts, strict=True)]
    _, first, which = np.unique(columns[0], return_index=True, return_inverse=True)
    return [*[c[first] for c in columns[:3]], *[np.bincount(which, weights=c).astype(np.int64) for c in columns[3:]]]


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed groups with their labelled documents to counts by key, summed within a task.

    ``key`` is a word's, with its first six bytes and ``h`` -1; or that of a class bigram, with the class before
    as ``h`` and its class in the first bytes.
    """
    def out(rows: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in rows], COUNT_COLUMNS)

    parts: list[list[np.ndarray]] = []
    size = 0
    for batch in batches:
        for _, cls, pieces_ in _labelled(batch):
            for a, _, data, offsets in pieces_:
                doc, (_, _, w, big, _), six, h = keys(data, offsets)
                if not len(w):
                    continue
                once = _firsts(doc, w, h)
                c = cls[a + doc[once]]
                counts = [(c == i).astype(np.int64) for i in range(4)]
                bytes_ = six[once].view(np.int64)
                words = [w[once].view(np.int64), bytes_, np.full(len(once), -1, np.int32), *counts]
                pairs = [big[once].view(np.int64), bytes_ & np.int64(0xFFFF << 32), h[once], *counts]
                parts += [_summed([words]), _summed([pairs])]
                size += len(parts[-1][0]) + len(parts[-2][0])
                if size > SUM_ROWS:
                    parts = [_summed(parts)]
                    size = len(parts[0][0])
                    if size > SUM_ROWS * 3 // 4:
                        yield out(parts[0])
                        parts, size = [], 0
    if parts:
        yield out(_summed(parts))


# ------------------------------------------------------------------ packed texts and their labels


def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, text) to groups: (ids, sizes, packed texts)."""
    ids, texts, size = [], [], 0

    def group() -> pa.RecordBatch:
        blob = zstandard.ZstdCompressor(level=6).compress(b"".join(texts))
        return pa.RecordBatch.from_arrays(
            [pa.array([ids], pa.list_(pa.int64())), pa.array([[len(t) for t in texts]], pa.list_(pa.int64())),
             pa.array([blob], pa.binary())], ["ids", "sizes", "blob"])

    for batch in batches:
        for i, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            raw = (t or "").encode()
            if texts and size + len(raw) > GROUP_BYTES:
                yield group()
                ids, texts, size = [], [], 0
            ids.append(i)
            texts.append(raw)
            size += len(raw)
    if texts:
        yield group()


def packed(docs: DataFrame) -> DataFrame:
    """(``group``, ``ids``, ``sizes``, ``blob``): all texts, stored by group."""
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = qualified(spark, f"tox_groups_{uuid.uuid4().hex[:10]}")
    groups = docs.select("doc_id", "text").mapInArrow(pack, "ids array<long>, sizes array<long>, blob binary")
    (groups.withColumn("group", F.monotonically_increasing_id()).write.format("parquet")
     .option("compression", "uncompressed").bucketBy(n, "group").saveAsTable(name))
    return spark.table(name)


def labelled(groups: DataFrame, labels: DataFrame) -> DataFrame:
    """(``group``, ``doc_id``, ``pos``, ``cls``): labelled documents outside the held-out third; cls = 2 * half + toxic."""
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("y"))
    fold = fold_of(F.col("doc_id"))
    rows = groups.select("group", F.posexplode("ids").alias("pos", "doc_id")).where(fold != HELD_OUT)
    # a merge join at every size: labels grow with the corpus, and AQE can split a repeated id
    rows = rows.join(known.hint("merge"), "doc_id")
    return rows.select("group", "doc_id", "pos",
                       (F.when(fold == 2, 2).otherwise(0) + (F.col("y") > 0).cast("int")).alias("cls"))


def with_labels(groups: DataFrame, rows: DataFrame) -> DataFrame:
    """Groups that hold documents of ``rows``, with those documents' places and classes."""
    lists = rows.groupBy("group").agg(F.collect_list("pos").alias("pos"), F.collect_list("cls").alias("cls"))
    return groups.join(lists.hint("merge"), "group")


def pieces(sizes: np.ndarray, data: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first document, end, bytes, offsets) of a group's texts, about a megabyte at a time."""
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    yield from text_chunks(pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(offsets), pa.py_buffer(data)))


def _labelled(batch: pa.RecordBatch):
    """(row, classes, pieces) of every group: only its labelled documents, if it comes with labels, or all."""
    names = batch.schema.names
    for i in range(batch.num_rows):
        sizes = batch.column("sizes")[i].values.to_numpy()
        data = np.frombuffer(zstandard.ZstdDecompressor().decompress(batch.column("blob")[i].as_py()), np.uint8)
        cls = None
        if "pos" in names:
            pos, cls = (np.asarray(batch.column(c)[i].values.to_numpy()) for c in ("pos", "cls"))
            begin = np.concatenate([[0], np.cumsum(sizes)])
            data = np.concatenate([data[begin[p]:begin[p + 1]] for p in pos])
            sizes = sizes[pos]
        yield i, cls, pieces(sizes, data)


# ------------------------------------------------------------------ smoothing (native)


COUNTS = [f"c{c}" for c in range(4)]


def _n(i: int, m: str) -> Column:
    """The count of class ``i`` under model ``m``."""
    first, *more = MODELS[m][i]
    return sum((F.col(f"c{c}") for c in more), F.col(f"c{first}")).cast("double")


def _discounts(df: DataFrame) -> dict[tuple[int, str], float]:
    """n1 / (n1 + 2 n2) of each class and model of a level: one row."""
    row = df.agg(*[F.count_if(_n(i, m) == v).alias(f"n{v}_{i}_{m}") for m in MODELS for i in (0, 1) for v in (1, 2)]).first()
    return {(i, m): row[f"n1_{i}_{m}"] / max(1, row[f"n1_{i}_{m}"] + 2 * row[f"n2_{i}_{m}"]) for m in MODELS for i in (0, 1)}


def _seen(m: str) -> Column:
    return _n(0, m) + _n(1, m) > 0


def top_level(df: DataFrame) -> DataFrame:
    """``P(k)`` of the classes: discounted counts over the shared number of histories (``t_*``)."""
    d = _discounts(df)
    sums = df.agg(*[F.coalesce(F.sum(v), F.lit(0.0)).alias(f"{n}_{m}") for m in MODELS for n, v in (
        ("n0", _n(0, m)), ("n1", _n(1, m)), ("f0", F.least(_n(0, m), F.lit(d[0, m]))),
        ("f1", F.least(_n(1, m), F.lit(d[1, m]))), ("t", F.col(f"t_{m}").cast("double")))]).first()
    p = [F.when(_seen(m), (F.greatest(_n(i, m) - d[i, m], F.lit(0.0))
                           + (sums[f"f{i}_{m}"] + PRIOR) * F.col(f"t_{m}") / max(1.0, sums[f"t_{m}"]))
                / (sums[f"n{i}_{m}"] + PRIOR)).alias(f"p{i}_{m}") for m in MODELS for i in (0, 1)]
    return df.select("key", "k", *COUNTS, *p)


def next_level(df: DataFrame, above: DataFrame, share: Callable[[str], Column]) -> DataFrame:
    """``P`` of a level from the one above: ``df`` has ``key``, its key above ``up``, counts; ``share`` the common share's weight."""
    d = _discounts(df)
    under = df.groupBy("up").agg(
        *[F.sum(F.least(_n(i, m), F.lit(d[i, m]))).alias(f"f{i}_{m}") for m in MODELS for i in (0, 1)],
        *[F.sum(share(m)).alias(f"g_{m}") for m in MODELS])
    over = above.select(F.col("key").alias("up"), *[F.col(f"p{i}_{m}").alias(f"q{i}_{m}") for m in MODELS for i in (0, 1)],
                        *[_n(i, m).alias(f"n{i}_{m}") for m in MODELS for i in (0, 1)])
    df = df.join(under.join(over.hint("merge"), "up").hint("merge"), "up")
    p = []
    for m in MODELS:
        for i in (0, 1):
            kept = F.greatest(_n(i, m) - d[i, m], F.lit(0.0))
            free = F.try_divide((F.col(f"f{i}_{m}") + PRIOR) * share(m), F.col(f"g_{m}"))
            p.append(F.when(_seen(m), F.col(f"q{i}_{m}") * (kept + free) / (F.col(f"n{i}_{m}") + PRIOR)).alias(f"p{i}_{m}"))
    return df.select("key", *[c for c in ("up", "k") if c in df.columns], *COUNTS, *p)


def _ratio(m: str, over: str | None = None) -> Column:
    r = F.try_divide(f"p1_{m}", f"p0_{m}")
    return F.log(r if over is None else F.try_divide(r, over)).cast("float").alias(f"r_{m}")


def bigram_level(df: DataFrame, top: DataFrame) -> DataFrame:
    """``P(k | h)`` of the class bigrams (``key``, ``k``, ``h``, counts), backing off to ``P(k)``."""
    d = _discounts(df)
    context = df.groupBy("h").agg(*[F.sum(v).alias(f"{n}{i}_{m}") for m in MODELS for i in (0, 1) for n, v in (
        ("n", _n(i, m)), ("f", F.least(_n(i, m), F.lit(d[i, m]))))])
    q = top.select("k", *[F.col(f"p{i}_{m}").alias(f"q{i}_{m}") for m in MODELS for i in (0, 1)])
    df = df.join(F.broadcast(q), "k").join(F.broadcast(context), "h")                # at most 2^16 classes each
    p = [F.when(_seen(m), (F.greatest(_n(i, m) - d[i, m], F.lit(0.0)) + (F.col(f"f{i}_{m}") + PRIOR) * F.col(f"q{i}_{m}"))
                / (F.col(f"n{i}_{m}") + PRIOR)).alias(f"p{i}_{m}") for m in MODELS for i in (0, 1)]
    return df.select("key", *p)


def ratios(groups: DataFrame) -> DataFrame:
    """(``key``, ``r_a``, ``r_b``, ``r_f``): log ratios of prefixes and words given their class, of classes and class bigrams."""
    counted = groups.select("sizes", "blob", "pos", "cls").mapInArrow(
        count_words, "key long, six long, h int, c0 long, c1 long, c2 long, c3 long")
    rows = written(counted.groupBy("key").agg(*[F.sum(c).alias(c) for c in COUNTS], F.min("six").alias("six"),
                                              F.min("h").alias("h")), "tox-counts", "snappy")
    rows = rows.withColumn("k", F.shiftright("six", 32)).withColumn("s6", F.col("six") + F.lit(SIX)).withColumn(
        "s4", F.shiftright("six", 16) + F.lit(FOUR))
    words, pairs = rows.where("h < 0"), rows.where("h >= 0")
    sums = [F.sum(c).alias(c) for c in COUNTS]
    types = [F.sum(_seen(m).cast("long")).alias(f"t_{m}") for m in MODELS]        # different continuations
    six = written(words.groupBy("s6").agg(*sums, *types, F.min("s4").alias("s4"), F.min("k").alias("k")), "tox-six", "snappy")
    four = written(six.groupBy("s4").agg(*sums, *types, F.min("k").alias("k")), "tox-four", "snappy")
    histories = pairs.groupBy("k").agg(*types, (F.col("k") + F.lit(CLASS)).alias("key"))
    two = written(four.groupBy("k").agg(*sums).join(histories, "k"), "tox-two", "snappy")
    top = written(top_level(two), "tox-level", "snappy")
    count = lambda m: F.col(f"t_{m}").cast("double")
    l4 = written(next_level(four.select(F.col("s4").alias("key"), F.col("k").alias("up"), "k", *COUNTS,
                                        *[f"t_{m}" for m in MODELS]),
                            top.drop("key").withColumnRenamed("k", "key"), count), "tox-level", "snappy")
    l6 = written(next_level(six.select(F.col("s6").alias("key"), F.col("s4").alias("up"), "k", *COUNTS,
                                       *[f"t_{m}" for m in MODELS]), l4, count), "tox-level", "snappy")
    lw = next_level(words.select("key", F.col("s6").alias("up"), "k", *COUNTS), l6, lambda m: _n(0, m) + _n(1, m))
    out = top.unionByName(bigram_level(pairs.select("key", "k", "h", *COUNTS), top), allowMissingColumns=True).select(
        "key", *[_ratio(m) for m in MODELS])
    base = F.broadcast(top.select("k", *[F.try_divide(f"p1_{m}", f"p0_{m}").alias(f"b_{m}") for m in MODELS]))
    for level in (l4, l6, lw):
        out = out.unionByName(level.join(base, "k").select("key", *[_ratio(m, f"b_{m}") for m in MODELS]))
    return written(out, "tox-ratios", "snappy")


# ------------------------------------------------------------------ evidence of documents


def group_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed groups to (group, key): the distinct keys of all levels."""
    for batch in batches:
        for i, _, pieces_ in _labelled(batch):
            found = [np.unique(np.concatenate(keys(data, offsets)[1])) for _, _, data, offsets in pieces_]
            if found:
                all_keys = np.unique(np.concatenate(found)).view(np.int64)
                g = batch.column("group")[i].as_py()
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(all_keys), g, np.int64)), pa.array(all_keys)],
                                                 ["group", "key"])


def word_ratios(levels: list[np.ndarray], known: np.ndarray, r: np.ndarray) -> np.ndarray:
    """The ratio of every word: its longest known prefix given its class, and its class given the one before (or alone)."""
    def look(key: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(known, key), len(known) - 1)
        return np.where(known[at] == key, r[at], np.nan)
    if not len(known):
        return np.zeros(len(levels[0]))
    four, six, word, bigram, two = (look(x.view(np.int64)) for x in levels)
    own = np.where(~np.isnan(word), word, np.where(~np.isnan(six), six, np.nan_to_num(four)))
    return own + np.where(~np.isnan(bigram), bigram, np.nan_to_num(two))


def evidence(r: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """Features of every text from its words' ratios; text ``d`` has the words ``bound[d]`` to ``bound[d + 1]``."""
    out = np.zeros((len(bound) - 1, FEATURES))
    total = np.concatenate([[0.0], np.cumsum(r)])
    for d in range(len(out)):
        a, b = bound[d], bound[d + 1]
        if b > a:
            w = min(WINDOW, b - a)
            passages = (total[a + w:b + 1] - total[a:b - w + 1]) / WINDOW
            own = r[a:b]
            top = np.partition(own, len(own) - TOP)[-TOP:] if len(own) > TOP else own
            out[d] = (total[b] - total[a]) / (b - a), passages.max(), top.sum() / TOP, np.log(b - a)
    return out


def features(groups: DataFrame, table_of_ratios: DataFrame, models: tuple[str, ...], score: Callable, schema: str) -> DataFrame:
    """``score`` over packed groups, with the known ratios of their keys by ``models``."""
    texts = [c for c in ("sizes", "blob", "pos", "cls") if c in groups.columns]
    wanted = groups.select("group", *texts).mapInArrow(group_keys, "group long, key long")
    known = wanted.join(table_of_ratios.select("key", *[F.coalesce(f"r_{m}", F.lit(float("nan")).cast("float")).alias(f"r_{m}")
                                                        for m in models]).hint("merge"), "key")
    # plain lists beside each other, none with a NULL: every row adds one element to each
    back = known.groupBy("group").agg(*[F.collect_list(c).alias(c) for c in ("key", *[f"r_{m}" for m in models])])
    return groups.join(back.hint("merge"), "group", "left").mapInArrow(score, schema)


def _evidence(batch: pa.RecordBatch, models: tuple[str, ...]):
    """(row, first document, end, classes, features by model) of every piece of every group."""
    for i, cls, pieces_ in _labelled(batch):
        found = batch.column("key")[i].values                          # None: nothing known
        known = np.zeros(0, np.int64) if found is None else found.to_numpy()
        order = np.argsort(known)
        known = known[order]
        r = [np.zeros(0) if found is None else
             batch.column(f"r_{m}")[i].values.to_numpy(zero_copy_only=False).astype(np.float64)[order] for m in models]
        for a, b, data, offsets in pieces_:
            doc, levels, _, _ = keys(data, offsets)
            bound = np.searchsorted(doc, np.arange(b - a + 1))
            yield i, a, b, cls, [evidence(word_ratios(levels, known, x), bound) for x in r]


def _crossed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Features of labelled documents, each by the counts of the other half."""
    names = [f"f{i}" for i in range(FEATURES)]
    for batch in batches:
        for _, a, b, cls, (first, second) in _evidence(batch, ("a", "b")):
            c = cls[a:b]
            x = np.where((c >= 2)[:, None], first, second)
            yield pa.RecordBatch.from_arrays([pa.array(x[:, i]) for i in range(FEATURES)]
                                             + [pa.array((c % 2).astype(np.int32))], [*names, "y"])


class Rising:
    """A logistic regression in which more evidence never lowers the score.

    Evidence that got a negative weight beside the rest is left out, the
    worst first, and the length (the last feature) stays within what was seen.
    """

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.low, self.high = (x[:, -1].min(), x[:, -1].max()) if len(x) else (0.0, 0.0)
        self.used = list(range(x.shape[1]))
        while True:
            self.logistic = Logistic(x[:, self.used], y)
            if self.logistic.constant is not None or len(self.used) == 1:
                return
            worst = int(np.argmin(self.logistic.weights[:len(self.used) - 1]))
            if self.logistic.weights[worst] >= 0:
                return
            del self.used[worst]

    def __call__(self, x: np.ndarray) -> np.ndarray:
        x = np.column_stack([x[:, :-1], np.clip(x[:, -1], self.low, self.high)])
        return self.logistic(x[:, self.used])


def _scorer(logistic: Rising) -> Callable:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, a, b, _, (x,) in _evidence(batch, ("f",)):
                ids = batch.column("ids")[i].values[a:b]
                yield pa.RecordBatch.from_arrays([ids, pa.array(logistic(x))], ["doc_id", "score"])
    return score


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(``doc_id``, ``score``) for every row of ``docs`` (doc_id, text)."""
    groups = packed(docs)
    train = written(labelled(groups, labels), "tox-train")
    n = train.groupBy("cls").count().collect()     # four rows
    count = {r["cls"]: r["count"] for r in n}
    rows = sum(count.values())
    if not all((count.get(c, 0) + count.get(c + 2, 0)) for c in (0, 1)):
        return docs.select("doc_id", F.lit(0.0).alias("score"))
    known = ratios(with_labels(groups, train))
    part = F.pmod(F.xxhash64("doc_id", F.lit("fit")), F.lit(1 << 20)) < int((1 << 20) * min(1.0, 1.1 * FIT_ROWS / rows))
    fit = features(with_labels(groups, train.where(part)), known, ("a", "b"), _crossed,
                   ", ".join(f"f{i} double" for i in range(FEATURES)) + ", y int").limit(FIT_ROWS).toArrow()
    x = np.stack([fit.column(f"f{i}").to_numpy() for i in range(FEATURES)], 1)
    logistic = Rising(x, fit.column("y").to_numpy())
    return features(groups, known, ("f",), _scorer(logistic), "doc_id long, score double")


def op9_toxicity(spark, sf_dir) -> DataFrame:
    scored = toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", (fold_of(F.col("doc_id")) == HELD_OUT).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
