"""Operator 11: spelling variants by Bloom-guided neighbourhoods.

The vocabulary holds every word of at least ``MIN_LENGTH`` code points that
occurs ``MIN_COUNT`` times or more.  Two words are near if one inserted,
deleted or replaced code point turns one into the other.

1. *Filters*: the vocabulary is dealt by length class (a length, or 64 for all
   longer ones) and, within a class, by hash into shards of about
   ``WORDS_PER_SHARD`` words.  Each shard becomes one blocked Bloom filter:
   blocks of four 64-bit lanes, two bits a lane, 32 bits a word.
2. *Probes*: every word's replacements and deletions are hashed by shifting its
   polynomial hash, a whole column of words at a time, and probed.  (A word's
   insertions are the deletions of longer words, seen from the other end.)
   Filters are broadcast ``ROUND_BYTES`` at a time; a larger vocabulary takes
   more rounds, each over the words of its own lengths, so what is broadcast
   never grows with the data.
3. *Join*: only positives are spelt out, shuffled and joined to the vocabulary,
   which removes the false ones.  Links are then counted per word.

Only letters that occur in the vocabulary are tried: no other replacement can be in it.

Cases: a NULL text has no words; a NULL id is written as nothing before the
colon; repeated rows count again; equal counts give the smaller form in
code-point order; words of any length are handled (letter by letter, so memory
does not grow with the square of the length); an empty vocabulary gives an
empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hopgraph.llm.common import table, written
from hopgraph.llm.hashing import mixed

RUN = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_LENGTH, MIN_COUNT, TIMES = 7, 2, 10
DAMAGED = 31                       # one (document, run) of so many loses a letter
LONGEST_CLASS = 64
WORDS_PER_SHARD = 1 << 16          # 256 KB of filter
BITS_PER_WORD = 32
ROUND_BYTES = 32 << 20             # filters broadcast at a time
ROWS_AT_ONCE = 4096                # words whose probes are worked on together
WORDS_PER_TASK = 20_000            # words that one task probes

_P = np.uint64(0x9E3779B97F4A7C15 | 1)
_P_INV = np.uint64(pow(int(_P), -1, 1 << 64))
_LETTER = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))


def words_of_documents(docs: DataFrame) -> DataFrame:
    """(``word``) one row for each run of at least MIN_LENGTH letters, damaged as stated."""
    run = F.explode(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(RUN), F.lit(0))).alias("run")
    low = F.translate("run", UPPER, LOWER)
    runs = (docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), run)
            .where(F.char_length("run") >= MIN_LENGTH).select("id", low.alias("run")))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    cut = F.pmod(F.col("h"), F.char_length("run")).cast("int")
    shorter = F.concat(F.expr("left(run, at)"), F.expr("substring(run, at + 2)"))
    return (runs.withColumn("h", h).withColumn("at", cut)
            .select(F.when(F.col("h") % DAMAGED == 0, shorter).otherwise(F.col("run")).alias("word"))
            .where(F.char_length("word") >= MIN_LENGTH))


def vocabulary(words: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """(``word``, ``n``, ``class``)."""
    return (words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)
            .withColumn("class", F.least(F.char_length("word"), F.lit(LONGEST_CLASS))))


# ------------------------------------------------------------------ hashes of words and of their edits


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_P, _P_INV):
        p = np.full(n + 1, base, np.uint64)
        p[0] = 1
        out.append(np.cumprod(p))
    return out[0], out[1]


def by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows, code points as a uint8 matrix) of words in U+0000..U+00FF."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for n in np.unique(lengths):
        rows = np.flatnonzero(lengths == n)
        step = max(1, min(ROWS_AT_ONCE, (1 << 22) // max(int(n), 1)))
        for i in range(0, len(rows), step):
            part = rows[i:i + step]
            flat = "".join(words[r] for r in part).encode("latin-1")
            yield int(n), part, np.frombuffer(flat, np.uint8).reshape(len(part), int(n))


def word_hashes(letters: np.ndarray, power: np.ndarray) -> np.ndarray:
    """Polynomial hashes (not finished) of the rows of a matrix of code points."""
    total = np.zeros(len(letters), np.uint64)
    for i in range(letters.shape[1]):
        total += _LETTER[letters[:, i]] * power[i]
    return total


def finished(total: np.ndarray, n: int) -> np.ndarray:
    return mixed(total + np.uint64(n))


# ------------------------------------------------------------------ blocked Bloom filters


def blocks_for(n_words: int) -> int:
    return max(1, -(-n_words * BITS_PER_WORD // 256))


def _bits(h: np.ndarray) -> np.ndarray:
    """Bits that pick the places in the lanes; the block comes from the hash itself."""
    return mixed(h ^ np.uint64(0xA0761D6478BD642F))


def _lane(g: np.ndarray, k: int) -> np.ndarray:
    """The two bits of lane ``k``, as masks."""
    one, low = np.uint64(1), np.uint64(63)
    return (one << ((g >> np.uint64(12 * k)) & low)) | (one << ((g >> np.uint64(12 * k + 6)) & low))


def bloom_filter(hashes: np.ndarray) -> np.ndarray:
    """(blocks, 4) lanes holding all the hashes."""
    out = np.zeros((blocks_for(len(hashes)), 4), np.uint64)
    block = (hashes % np.uint64(len(out))).astype(np.int64)
    for k in range(4):
        np.bitwise_or.at(out[:, k], block, _lane(_bits(hashes), k))
    return out


class Shards:
    """The filters of one length class, one after the other; parts that are not held hold nothing."""

    def __init__(self, bits: dict[int, bytes], n_parts: int):
        self.n_parts = n_parts
        held = sorted(bits)
        self.lanes = np.concatenate([np.frombuffer(bits[p], np.uint64).reshape(-1, 4) for p in held])
        self.blocks = np.zeros(n_parts, np.uint64)
        self.blocks[held] = [len(bits[p]) // 32 for p in held]
        self.first = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.blocks)[:-1]])

    def hits(self, hashes: np.ndarray) -> np.ndarray:
        """Places of the hashes that may be held."""
        if self.n_parts == 1:
            return np.flatnonzero(bloom_has(self.lanes, hashes))
        part = shard_of(hashes, self.n_parts)
        some = np.flatnonzero(self.blocks[part])
        h, part = hashes[some], part[some]
        return some[bloom_has(self.lanes, h, self.first[part] + h % self.blocks[part])]


def bloom_has(lanes: np.ndarray, hashes: np.ndarray, block: np.ndarray | None = None) -> np.ndarray:
    """Which hashes may be in the filter: each lane looks only at what the lane before let through."""
    left = np.arange(len(hashes))
    block = (hashes % np.uint64(len(lanes)) if block is None else block).astype(np.int64)
    bits = _bits(hashes)
    for k in range(4):
        mask = _lane(bits[left], k)
        left = left[(lanes[block[left], k] & mask) == mask]
    out = np.zeros(len(hashes), bool)
    out[left] = True
    return out


def shard_of(h: np.ndarray, n_parts: int) -> np.ndarray:
    return ((h >> np.uint64(40)) % np.uint64(n_parts)).astype(np.int64)


def build_filters(vocab: DataFrame, parts: dict[int, int]) -> DataFrame:
    """(``class``, ``part``, ``bits``) one Bloom filter for each shard, built where its hashes meet."""
    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = b.column("word").to_pylist()
            for n, rows, letters in by_length(words):
                h = finished(word_hashes(letters, powers(n)[0]), n)
                c = min(n, LONGEST_CLASS)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(h), c, np.int32)), pa.array(shard_of(h, parts[c]).astype(np.int32)),
                     pa.array(h.view(np.int64))], names=["class", "part", "h"])

    def build(key: tuple, g: pd.DataFrame) -> pd.DataFrame:
        lanes = bloom_filter(g["h"].to_numpy().view(np.uint64))
        return pd.DataFrame({"class": [key[0]], "part": [key[1]], "bits": [lanes.tobytes()]})

    shards = vocab.select("word").mapInArrow(hashes, "class int, part int, h long")
    return shards.groupBy("class", "part").applyInPandas(build, "class int, part int, bits binary")


# ------------------------------------------------------------------ probes


def edits(letters: np.ndarray, alphabet: np.ndarray, power: np.ndarray, inverse: np.ndarray
          ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(place, new length, rows, new letters or -1, finished hashes) of all replacements and deletions."""
    m, n = letters.shape
    total = word_hashes(letters, power)
    before = np.zeros(m, np.uint64)                       # hash of the letters before the place
    rows = np.repeat(np.arange(m), len(alphabet))
    tried = np.tile(alphabet, m)
    for i in range(n):
        here = _LETTER[letters[:, i]] * power[i]
        other = tried != letters[rows, i]
        r, c = rows[other], tried[other]
        yield i, n, r, c.astype(np.int64), finished((total - here)[r] + _LETTER[c] * power[i], n)
        after = (total - before - here) * inverse[1]
        # of a run of equal letters one deletion is enough
        r = np.flatnonzero(letters[:, i] != letters[:, i - 1]) if i else np.arange(m)
        yield i, n - 1, r, np.full(len(r), -1), finished((before + after)[r], n - 1)
        before = before + here


def spelt(word: str, place: int, letter: int) -> str:
    return word[:place] + ("" if letter < 0 else chr(letter)) + word[place + 1:]


def probe(vocab: DataFrame, filters: dict[tuple[int, int], bytes], parts: dict[int, int],
          alphabet: list[int], min_length: int) -> DataFrame:
    """(``word``, ``n``, ``near``, ``shorter``): edits that the broadcast filters may hold."""
    shared = vocab.sparkSession.sparkContext.broadcast(filters)
    classes = sorted({c for c, _ in filters})
    mine = [c for c in classes] + [c + 1 for c in classes if c < LONGEST_CLASS]
    held = set(classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = {c: Shards({p: v for (k, p), v in shared.value.items() if k == c}, parts[c]) for c in held}
        tried = np.array(alphabet, np.uint8)
        for b in batches:
            words, counts = b.column("word").to_pylist(), b.column("n").to_numpy()
            for n, at, letters in by_length(words):
                power, inverse = powers(n)
                found: list[tuple[str, int, str, bool]] = []
                for place, size, rows, new, h in edits(letters, tried, power, inverse):
                    c = min(size, LONGEST_CLASS)
                    if size < min_length or c not in held:
                        continue
                    for j in shards[c].hits(h):
                        r = at[rows[j]]
                        found.append((words[r], int(counts[r]), spelt(words[r], place, int(new[j])), size < n))
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(col) for col in zip(*found, strict=True)], names=["word", "n", "near", "shorter"])

    rows = vocab.where(F.col("class").isin(sorted(set(mine)))).select("word", "n")
    rows = rows.repartition(rows.count() // WORDS_PER_TASK + 1, "word")
    return rows.mapInArrow(run, "word string, n long, near string, shorter boolean")


def positives(vocab: DataFrame, min_length: int = MIN_LENGTH, round_bytes: int = ROUND_BYTES,
              words_per_shard: int = WORDS_PER_SHARD) -> list[DataFrame]:
    """Written tables of probe hits, one for each round of filters."""
    sizes = {r["class"]: r["count"] for r in vocab.groupBy("class").count().collect()}     # at most 64 rows
    if not sizes:
        return []
    parts = {c: -(-n // words_per_shard) for c, n in sizes.items()}
    letters = F.explode(F.split("word", "")).alias("c")
    alphabet = sorted(ord(r.c) for r in vocab.select(letters).where("c <> ''").distinct().collect())  # at most 90
    filters = written(build_filters(vocab, parts), "spelling-filters")
    shard_bytes = {(c, p): blocks_for(-(-sizes[c] // parts[c])) * 32 for c in sizes for p in range(parts[c])}
    rounds: list[list[tuple[int, int]]] = []
    room = 0
    for key in sorted(shard_bytes):
        if not rounds or shard_bytes[key] > room:
            rounds.append([])
            room = round_bytes
        rounds[-1].append(key)
        room -= shard_bytes[key]
    out = []
    for keys in rounds:
        first, last = keys[0], keys[-1]
        some = filters.where(F.struct("class", "part").between(
            F.struct(F.lit(first[0]), F.lit(first[1])), F.struct(F.lit(last[0]), F.lit(last[1])))).collect()
        bits = {(r["class"], r["part"]): bytes(r["bits"]) for r in some}       # round_bytes, and one shard at most
        out.append(written(probe(vocab, bits, parts, alphabet, min_length), "spelling-hits"))
    return out


def links(vocab: DataFrame, hits: DataFrame) -> DataFrame:
    """(``word``, ``n``, ``near``, ``near_n``) in both directions; the join drops what is not in the vocabulary."""
    true = hits.join(vocab.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    ends = F.when(F.col("shorter"), F.array(
        F.struct("word", "n", "near", "near_n"),
        F.struct(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"),
                 F.col("n").alias("near_n")))).otherwise(F.array(F.struct("word", "n", "near", "near_n")))
    return true.select(F.inline(ends))


def roots(forms: DataFrame) -> DataFrame:
    """(``word``, ``root``) of the words that have a form.

    A form is TIMES as frequent as its word, so no chain is longer than the digits of the largest count.
    """
    step = forms.select(F.col("word").alias("root"), F.col("form").alias("next"))
    done, moving = [], forms.select("word", F.col("form").alias("root"))
    while True:
        moved = written(moving.join(step, "root", "left"), "spelling-roots")
        done.append(moved.where("next IS NULL").select("word", "root"))
        moving = moved.where("next IS NOT NULL").select("word", F.col("next").alias("root"))
        if moving.isEmpty():
            break
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def spelling_variants(words: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
                      times: int = TIMES, **sizes) -> DataFrame:
    """(``word``, ``n``, ``n_near``, ``form``, ``form_n``, ``root``) for every word of the vocabulary."""
    vocab = written(vocabulary(words, min_count), "spelling-vocabulary")
    hits = positives(vocab, min_length, **sizes)
    none = words.sparkSession.createDataFrame([], "word string, n long, near string, shorter boolean")
    found = hits[0] if hits else none
    for h in hits[1:]:
        found = found.unionByName(h)
    # the largest count, then the smallest word: struct order of (-near_n, near)
    best: Column = F.min(F.struct((-F.col("near_n")).alias("m"), "near"))
    near = links(vocab, found).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    joined = vocab.join(near, "word", "left").withColumn("top", -F.col("best.m"))
    enough = F.col("top") >= F.col("n") * times
    formed = written(joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(enough, F.col("best.near")).alias("form"), F.when(enough, F.col("top")).alias("form_n")),
        "spelling-forms")
    ends = roots(formed.where("form IS NOT NULL").select("word", "form"))
    return formed.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))


def op11_spelling(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return spelling_variants(words_of_documents(docs)).select("word", "n", "n_near", "form", "form_n", "root")


#: CRC-32 byte by byte, over a table derived from its polynomial; edits by shared remainders of one deletion
SQL = """
WITH RECURSIVE crc_bits AS (
  SELECT i::BIGINT AS i, i::BIGINT AS c, 0 AS k FROM range(256) r(i)
  UNION ALL
  SELECT i, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, k + 1 FROM crc_bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM crc_bits WHERE k = 8),
runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id,
         unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\\x{C0}-\\x{FF}]+')) AS raw
  FROM documents),
low AS (
  SELECT id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS times
  FROM runs WHERE length(raw) >= 7 GROUP BY ALL),
hashed AS (
  SELECT run, times, xor(list_reduce(
           list_transform(range(octet_length(encode(id || ':' || run))),
             lambda j: (instr('123456789ABCDEF', substr(hex(encode(id || ':' || run)), 2 * j + 1, 1)) * 16
                        + instr('123456789ABCDEF', substr(hex(encode(id || ':' || run)), 2 * j + 2, 1)))::BIGINT),
           lambda c, b: xor(c // 256, t[(xor(c, b) % 256) + 1]), 4294967295::BIGINT), 4294967295) AS h
  FROM low, crc),
words AS (
  SELECT CASE WHEN h % 31 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2)
              ELSE run END AS word, times FROM hashed),
vocab AS (SELECT word, sum(times)::BIGINT AS n FROM words WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2),
less AS (
  SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1))::INT AS i FROM vocab)),
shorter AS (SELECT DISTINCT l.word AS a, l.n AS an, v.word AS b, v.n AS bn FROM less l JOIN vocab v ON v.word = l.rest),
near AS (
  SELECT a AS word, an AS n, b AS near, bn AS near_n FROM shorter
  UNION ALL SELECT b, bn, a, an FROM shorter
  UNION ALL SELECT x.word, x.n, y.word, y.n FROM less x JOIN less y ON x.i = y.i AND x.rest = y.rest AND x.word <> y.word),
best AS (
  SELECT word, count(*) AS n_near, min(struct_pack(m := -near_n, w := near)) AS top FROM near GROUP BY word),
formed AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near,
         CASE WHEN -top.m >= 10 * n THEN top.w END AS form, CASE WHEN -top.m >= 10 * n THEN -top.m END AS form_n
  FROM vocab v LEFT JOIN best USING (word)),
chain AS (
  SELECT word, word AS root, form AS next FROM formed
  UNION ALL
  SELECT c.word, c.next, f.form FROM chain c JOIN formed f ON f.word = c.next)
SELECT f.word, n, n_near, form, form_n, c.root
FROM formed f JOIN chain c ON c.word = f.word AND c.next IS NULL
"""
