"""Vectorised word hashing over Arrow text columns (numpy, per partition).

Words are ``[^\\x20\\x09-\\x0D]+`` over UTF-8 bytes with A-Z lower-cased.  A
word's 64-bit hash is a polynomial over random byte values, finished by a
mixer; everything runs over whole byte buffers, without a loop over words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20        # texts worked on at once; a longer text is a chunk of its own

_R = np.uint64(0x9E3779B97F4A7C15 | 1)
_R_INV = np.uint64(pow(int(_R), -1, 1 << 64))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: separates plain tokens: every ASCII byte that is no letter or digit
PUNCTUATION = np.ones(256, dtype=bool)
PUNCTUATION[128:] = False
for _a, _b in ((48, 58), (65, 91), (97, 123)):
    PUNCTUATION[_a:_b] = False


def mixed(x: np.ndarray) -> np.ndarray:
    """Finish 64-bit values (the splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES + (1 << 16))
        for i, r in ((0, _R), (1, _R_INV)):
            p = np.full(size, r, np.uint64)
            p[0] = 1
            _powers[i] = np.cumprod(p)
    return _powers[0][:n], _powers[1][:n]


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, row offsets into them) over a text column; NULL counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    n = len(column)
    if n == 0:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield i, j, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        i = j


def word_spans(data: np.ndarray, offsets: np.ndarray, between: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document number) of every word of a chunk."""
    if len(data) == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = ~between[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | edge[1:-1]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | edge[1:-1]
    s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
    return s, e, np.searchsorted(offsets, s, side="right") - 1


def span_hashes(data: np.ndarray, spans: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    """Hashes of byte spans (start, end), for several lists of spans over the same bytes."""
    power, inverse = _powers_to(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[_LOWER[data]] * power, out=total[1:])
    return [mixed((total[e] - total[s]) * inverse[s] + (e - s).astype(np.uint64)) for s, e in spans]


def word_hashes(data: np.ndarray, offsets: np.ndarray,
                between: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document number) of every word of a chunk, in text order."""
    s, e, doc = word_spans(data, offsets, between)
    return (span_hashes(data, [(s, e)])[0] if len(s) else np.zeros(0, np.uint64)), doc


def gram_hashes(words: np.ndarray, n: int, places: tuple[int, ...] | None = None) -> np.ndarray:
    """Hashes of all runs of ``n`` words (whatever document they are in), or of some places of each run."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(m, n, np.uint64)
    for i in places or range(n):
        out = out * np.uint64(0xA0761D6478BD642F) + words[i:i + m]
        out ^= out >> np.uint64(29)
    return mixed(out)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> list[np.ndarray]:
    """For each document the sorted distinct hashes of its ``n``-word shingles.

    A document of fewer words has its whole sequence as the one shingle; one
    without words has none.
    """
    words, doc = word_hashes(data, offsets)
    grams = gram_hashes(words, n)
    bound = np.searchsorted(doc, np.arange(len(offsets)))
    out = []
    for a, b in zip(bound[:-1].tolist(), bound[1:].tolist(), strict=True):
        if b - a >= n:
            g = np.sort(grams[a:b - n + 1])
            keep = np.ones(len(g), bool)
            np.not_equal(g[1:], g[:-1], out=keep[1:])
            out.append(g[keep])
        else:
            out.append(gram_hashes(words[a:b], b - a) if b > a else np.zeros(0, np.uint64))
    return out
