"""Operator 8: unigram token counts by dynamic programming on a shared trie.

Pre-tokens are the words of a text behind a word mark.  The distinct ones of a
stretch of text go into a byte trie, built level by level; the best unigram
segmentation of a prefix (its forward score) is computed once for each node
and so shared by all pre-tokens that begin alike; a terminal node's value is
its pre-token's count.  Counts of recent pre-tokens are remembered in a cache
of bounded size, so only new ones enter a trie.

The vocabulary is the list of pieces of a public tokenizer file (a parameter;
nothing is trained).  Its order gives the unigram scores by Zipf's law; any
byte can stand alone at a score below all pieces, so every text has a
segmentation.  Among segmentations of equal score the fewest tokens count.
Scores are integers, so sums are exact.

Cases: NULL, empty and blank texts have no tokens; very long pre-tokens take
the same recurrence one by one; repeated rows give the same counts; an empty
table gives an empty result; other columns may have any names.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from hopgraph.llm.common import table
from hopgraph.llm.hashing import mixed, text_chunks, word_spans

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁".encode()
LONG = 96                   # longer pre-tokens (bytes) are scored one by one
CHUNK_BYTES = 4 << 20
CACHE = 1 << 20             # remembered pre-tokens
_SCALE = 1_000_000
_BITS = 21


def read_pieces(path: str = VOCABULARY) -> list[bytes]:
    """The pieces of a sentencepiece file, in its order, without control and byte pieces."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return [sp.id_to_piece(i).encode() for i in range(sp.get_piece_size())
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]


class Vocabulary:
    """Pieces with integer log-probabilities: score by exact bytes, and by hash for whole arrays."""

    def __init__(self, pieces: list[bytes]):
        norm = sum(1 / (r + 2.7) for r in range(len(pieces)))
        self.score = {}
        for r, p in enumerate(pieces):
            self.score.setdefault(p, -round(_SCALE * math.log((r + 2.7) * norm)))
        self.single = min(self.score.values(), default=0) - 10 * _SCALE
        self.longest = max(map(len, self.score), default=1)
        keys = np.array([_key(p) for p in self.score], np.uint64)
        order = np.argsort(keys)
        self.keys, self.values = keys[order], np.array(list(self.score.values()), np.int64)[order]
        if len(np.unique(keys)) != len(keys):
            raise ValueError("two pieces share a hash")
        self.seen = np.zeros(1 << _BITS, bool)
        self.seen[self.keys >> np.uint64(64 - _BITS)] = True

    def lookup(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places, scores) of the keys that are pieces."""
        i = np.flatnonzero(self.seen[keys >> np.uint64(64 - _BITS)])
        at = np.minimum(np.searchsorted(self.keys, keys[i]), len(self.keys) - 1)
        hit = self.keys[at] == keys[i]
        return i[hit], self.values[at[hit]]

    def count_one(self, word: bytes) -> int:
        """Tokens of the best segmentation of one marked pre-token (the plain recurrence)."""
        best, count = [0], [0]
        for e in range(1, len(word) + 1):
            top, few = best[e - 1] + self.single, count[e - 1] + 1
            for s in range(max(0, e - self.longest), e):
                v = self.score.get(word[s:e])
                if v is not None and (best[s] + v, -count[s] - 1) > (top, -few):
                    top, few = best[s] + v, count[s] + 1
            best.append(top)
            count.append(few)
        return count[-1]


_M = np.uint64(0x9E3779B97F4A7C15)
_M_INV = np.uint64(pow(int(_M), -1, 1 << 64))
_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))


def _totals(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums whose differences, times the second array at the start, are span hashes."""
    p = np.full(len(data) + 1, _M, np.uint64)
    p[0] = 1
    q = np.full(len(data) + 1, _M_INV, np.uint64)
    q[0] = 1
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * np.cumprod(p)[:-1], out=total[1:])
    return total, np.cumprod(q)


def _key(piece: bytes) -> int:
    total, inverse = _totals(np.frombuffer(piece, np.uint8))
    return int(mixed(np.array([(total[-1] - total[0]) * inverse[0]]))[0])


def trie_counts(words: list[bytes], vocabulary: Vocabulary) -> np.ndarray:
    """Token counts of distinct pre-tokens (unmarked) through one trie."""
    out = np.zeros(len(words), np.int64)
    short = [i for i, w in enumerate(words) if len(w) <= LONG]
    for i, w in enumerate(words):
        if len(w) > LONG:
            out[i] = vocabulary.count_one(MARK + w)
    if not short:
        return out
    short.sort(key=lambda i: -len(words[i]))
    marked = [MARK + words[i] for i in short]
    size = np.array([len(w) for w in marked])
    begin = np.cumsum(size) - size
    data = np.frombuffer(b"".join(marked), np.uint8)
    total, inverse = _totals(data)
    node_at = [np.zeros(len(marked), np.int64)]           # per depth, the node of each pre-token that reaches it
    best, count = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)]
    for depth in range(1, int(size[0]) + 1):
        live = int(np.searchsorted(-size, -depth, side="right"))      # longest first
        step = node_at[-1][:live] * 256 + data[begin[:live] + depth - 1]
        _, first, node = np.unique(step, return_index=True, return_inverse=True)
        top = best[-1][node_at[-1][first]] + vocabulary.single        # the last byte alone
        few = count[-1][node_at[-1][first]] + 1
        for n in range(1, min(depth, vocabulary.longest) + 1):
            s = begin[first] + depth - n
            at, value = vocabulary.lookup(mixed((total[s + n] - total[s]) * inverse[s]))
            if len(at):
                up = node_at[depth - n][first[at]]
                score, tokens = best[depth - n][up] + value, count[depth - n][up] + 1
                better = (score > top[at]) | ((score == top[at]) & (tokens < few[at]))
                top[at[better]], few[at[better]] = score[better], tokens[better]
        node_at.append(node)
        best.append(top)
        count.append(few)
        ends = np.flatnonzero(size[:live] == depth)
        out[np.array(short, np.int64)[ends]] = few[node[ends]]         # terminal nodes
    return out


class Counter:
    """Counts tokens of texts; remembers at most ``CACHE`` pre-tokens between stretches."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.known, self.value = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def count(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(pre-tokens, tokens) of every text."""
        n_words, n_tokens = np.zeros(len(column), np.int64), np.zeros(len(column), np.int64)
        for row, end, data, offsets in text_chunks(column, CHUNK_BYTES):
            s, e, doc = word_spans(data, offsets)
            if not len(s):
                continue
            total, inverse = _totals(data)
            key, first, which = np.unique(mixed((total[e] - total[s]) * inverse[s]), return_index=True,
                                          return_inverse=True)
            at = np.searchsorted(self.known, key)
            old = at < len(self.known)
            old[old] = self.known[at[old]] == key[old]
            value = np.zeros(len(key), np.int64)
            value[old] = self.value[at[old]]
            new = np.flatnonzero(~old)
            raw = data.tobytes()
            value[new] = trie_counts([raw[a:b] for a, b in zip(s[first[new]].tolist(), e[first[new]].tolist(),
                                                                 strict=True)], self.vocabulary)
            if len(self.known) + len(new) > CACHE:
                self.known, self.value = key, value
            else:
                both = np.concatenate([self.known, key[new]])
                order = np.argsort(both, kind="stable")
                self.known, self.value = both[order], np.concatenate([self.value, value[new]])[order]
            n_words[row:end] = np.bincount(doc, minlength=end - row)
            n_tokens[row:end] = np.bincount(doc, value[which], minlength=end - row).astype(np.int64)
        return n_words, n_tokens


def _counting(shared) -> Callable:
    def count(batches):
        counter = Counter(shared.value)
        for batch in batches:
            words, tokens = counter.count(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(words), pa.array(tokens)],
                                             ["doc_id", "n_pretokens", "n_tokens"])
    return count


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(``doc_id``, ``n_pretokens``, ``n_tokens``) for every row of ``docs``; map-side only."""
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(read_pieces(vocabulary)))
    return docs.select("doc_id", "text").mapInArrow(
        _counting(shared), "doc_id long, n_pretokens long, n_tokens long")


def op8_token_counts(spark, sf_dir) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))
