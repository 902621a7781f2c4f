"""Operator 7: main text of pages by a recurrent block labeller.

A page becomes its sequence of leaf blocks (:mod:`html_blocks`).  Each block
is a vector of its hashed tag-path labels, its hashed words and some measures;
a bidirectional LSTM (numpy) reads the whole sequence and labels every block
as article or not, so a block's label rests on all of its page.

It is trained here on a bounded sample, ``TRAIN_PAGES`` distinct pages, the
first ``TRAIN_CHARS`` characters of each (for training only).  Labels come from elements and names whose
meaning is plain (``article``, ``nav``, ``footer``, an ``ad`` class ...);
blocks without such a sign carry no loss.  Besides the pages themselves, the
sample's texts are set into other page frames (sidebars, notices, adverts,
forms, reader comments, other article containers), with path labels left out
at random, so that words, measures and neighbours count as well.

Cases: a NULL or empty page, and one without an article block, gives an empty
text; broken markup is read as far as it goes; very long pages are read whole,
and train like others if there are no shorter ones; repeated pages give the
same text and train once; no pages give an empty result; other columns may
have any names.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hopgraph.llm.common import table
from hopgraph.llm.hashing import text_chunks, word_hashes
from hopgraph.llm.html_blocks import Block, blocks

PATH_DIM, WORD_DIM, HIDDEN = 96, 32, 24
TRAIN_PAGES = 250
TRAIN_CHARS = 60_000
FRAMES = 700               # pages made from the sample's texts
EPOCHS = 7
STEP_CELLS = 1 << 21       # padded input values labelled at once
# fixed values: names that tell what a container holds
OTHER_TAGS = frozenset("nav footer aside form menu header button dialog".split())
OTHER_NAMES = ("ad ads advert advertisement banner breadcrumb breadcrumbs comment comments cookie consent footer header "
               "login menu nav navbar newsletter notice pagination popup promo related respond share sidebar social "
               "sponsor sponsored subscribe tags toolbar widget").split()
MAIN_TAGS = frozenset(["article", "main"])
MAIN_NAMES = "article body content entry main post story text".split()


def sign(path: tuple[str, ...]) -> int | None:
    """1 article, 0 other, None unknown: the innermost plain sign on a tag path, other before article."""
    other, main = set(OTHER_NAMES), set(MAIN_NAMES)
    inside = False
    for label in path:
        if "." not in label:
            if label in MAIN_TAGS:
                inside = True
            elif label in OTHER_TAGS and not (label == "header" and inside):
                return 0
        else:
            name = label.split(".", 1)[1]
            if name in other:
                return 0
            inside = inside or name in main
    return 1 if inside else None


_path_cache: dict[tuple[str, ...], np.ndarray] = {}


def path_vector(path: tuple[str, ...]) -> np.ndarray:
    v = _path_cache.get(path)
    if v is None:
        v = np.zeros(PATH_DIM, np.float32)
        for label in path:
            h = zlib.crc32(label.encode())
            v[h % PATH_DIM] += 1 if h & (1 << 20) else -1
        if len(_path_cache) > 50_000:
            _path_cache.clear()
        _path_cache[path] = v = np.clip(v, -2, 2)
    return v


def vectors(pages: list[list[Block]]) -> list[np.ndarray]:
    """Features of the blocks of each page, in order; all pages are worked on together."""
    every = [b for p in pages for b in p]
    n = len(every)
    if not n:
        return [np.zeros((0, DIM), np.float32) for _ in pages]
    words = np.zeros((n, WORD_DIM), np.float32)
    for row, end, data, offsets in text_chunks(pa.array([b.text for b in every], pa.string())):
        h, doc = word_hashes(data, offsets)
        flat = np.bincount(doc * WORD_DIM + (h % np.uint64(WORD_DIM)).astype(np.int64), minlength=(end - row) * WORD_DIM)
        words[row:end] = flat.reshape(-1, WORD_DIM)
    counts = words.sum(1)
    words /= np.maximum(1, np.sqrt((words ** 2).sum(1, keepdims=True)))
    size = np.array([len(b.text) for b in every], np.float32)
    each = np.array([len(p) for p in pages])
    rank = (np.arange(n) - np.repeat(np.cumsum(each) - each, each)).astype(np.float32)
    extra = np.column_stack([
        np.log1p(size) / 5, np.log1p(counts) / 4, np.array([b.link_chars for b in every], np.float32) / np.maximum(1, size),
        rank / np.repeat(np.maximum(1, each - 1), each), np.minimum(1, rank / 10),
        np.array([b.text[-1] in ".!?:;" for b in every], np.float32),
        np.array([len(b.path) for b in every], np.float32) / 10])
    x = np.concatenate([np.stack([path_vector(b.path) for b in every]), words, extra], 1).astype(np.float32)
    return np.split(x, np.cumsum(each)[:-1])


DIM = PATH_DIM + WORD_DIM + 7


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """A bidirectional LSTM with one logistic output for each step."""

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        h = HIDDEN
        self.w = {}
        for d in "fb":
            self.w[f"x{d}"] = (r.standard_normal((DIM, 4 * h)) / np.sqrt(DIM)).astype(np.float32)
            self.w[f"h{d}"] = (r.standard_normal((h, 4 * h)) / np.sqrt(h)).astype(np.float32)
            self.w[f"c{d}"] = np.repeat(np.array([0, 1, 0, 0], np.float32), h)
        self.w["o"] = (r.standard_normal(2 * h) / np.sqrt(2 * h)).astype(np.float32)
        self.w["p"] = np.zeros(1, np.float32)

    def _pass(self, x: np.ndarray, mask: np.ndarray, d: str, keep: list | None) -> np.ndarray:
        steps, pages, _ = x.shape
        h = c = np.zeros((pages, HIDDEN), np.float32)
        out = np.zeros((steps, pages, HIDDEN), np.float32)
        pre = x @ self.w[f"x{d}"] + self.w[f"c{d}"]
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            z = pre[t] + h @ self.w[f"h{d}"]
            i, f, o = np.split(_sigmoid(z[:, :3 * HIDDEN]), 3, 1)
            g = np.tanh(z[:, 3 * HIDDEN:])
            m = mask[t][:, None]
            c2 = f * c + i * g
            tc = np.tanh(c2)
            if keep is not None:
                keep.append((t, i, f, o, g, c, h, tc, m))
            c = m * c2 + (1 - m) * c
            h = m * (o * tc) + (1 - m) * h
            out[t] = h
        return out

    def scores(self, x: np.ndarray, mask: np.ndarray, keep: dict | None = None) -> np.ndarray:
        kf, kb = ([], []) if keep is not None else (None, None)
        hs = np.concatenate([self._pass(x, mask, "f", kf), self._pass(x, mask, "b", kb)], 2)
        if keep is not None:
            keep.update(f=kf, b=kb, hs=hs)
        return _sigmoid(hs @ self.w["o"] + self.w["p"])

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict:
        keep: dict = {}
        err = (self.scores(x, mask, keep) - y) * weight / max(1.0, weight.sum())
        grad = {"o": np.tensordot(err, keep["hs"], ([0, 1], [0, 1])), "p": np.array([err.sum()])}
        back = err[:, :, None] * self.w["o"]
        for k, d in enumerate("fb"):
            dz_all = np.zeros((*x.shape[:2], 4 * HIDDEN), np.float32)
            wh = self.w[f"h{d}"]
            gh = np.zeros_like(wh)
            dh = dc = np.zeros((x.shape[1], HIDDEN), np.float32)
            for t, i, f, o, g, c, h, tc, m in reversed(keep[d]):
                dh = dh + back[t][:, k * HIDDEN:(k + 1) * HIDDEN]
                dh2, dc2 = dh * m, dc * m
                dct = dc2 + dh2 * o * (1 - tc * tc)
                dz = np.concatenate([dct * g * i * (1 - i), dct * c * f * (1 - f), dh2 * tc * o * (1 - o),
                                     dct * i * (1 - g * g)], 1)
                dz_all[t] = dz
                gh += h.T @ dz
                dh = dh * (1 - m) + dz @ wh.T
                dc = dc * (1 - m) + dct * f
            grad[f"h{d}"] = gh
            grad[f"x{d}"] = np.tensordot(x, dz_all, ([0, 1], [0, 1]))
            grad[f"c{d}"] = dz_all.sum((0, 1))
        return grad

    def train(self, pages: list[np.ndarray], labels: list[np.ndarray], seed: int = 11) -> None:
        """Adam over batches of pages of like length; labels below 0 carry no loss."""
        r = np.random.default_rng(seed)
        order = sorted(range(len(pages)), key=lambda k: len(pages[k]))
        groups = [order[i:i + 24] for i in range(0, len(order), 24)]
        first = {k: np.zeros(v.shape) for k, v in self.w.items()}
        second = {k: np.zeros(v.shape) for k, v in self.w.items()}
        step = 0
        for _ in range(EPOCHS):
            for gi in r.permutation(len(groups)):
                x, mask, y = padded([pages[k] for k in groups[gi]], [labels[k] for k in groups[gi]])
                drop = (r.random((*x.shape[:2], PATH_DIM)) > 0.1).astype(np.float32)
                x[:, :, :PATH_DIM] *= drop
                step += 1
                for k, g in self.gradients(x, mask, np.maximum(y, 0), (y >= 0) * mask).items():
                    g = np.clip(g, -1, 1)
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.99 * second[k] + 0.01 * g * g
                    move = first[k] / (1 - 0.9 ** step) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-8)
                    self.w[k] = (self.w[k] - 0.02 * move).astype(np.float32)

    def label(self, pages: list[list[Block]]) -> list[np.ndarray]:
        """For each page, which blocks are article text; pages of like length are read side by side."""
        out = [np.zeros(0, bool)] * len(pages)
        features = vectors(pages)
        order = sorted((k for k in range(len(pages)) if pages[k]), key=lambda k: len(pages[k]))
        i = 0
        while i < len(order):
            j = i + 1
            while j < len(order) and (j - i + 1) * len(pages[order[j]]) * DIM <= STEP_CELLS:
                j += 1
            x, mask, _ = padded([features[k] for k in order[i:j]])
            p = self.scores(x, mask)
            for column, k in enumerate(order[i:j]):
                out[k] = p[:len(pages[k]), column] >= 0.5
            i = j
        return out


def padded(pages: list[np.ndarray], labels: list[np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    steps = max(len(p) for p in pages)
    x = np.zeros((steps, len(pages), DIM), np.float32)
    mask = np.zeros((steps, len(pages)), np.float32)
    y = np.full((steps, len(pages)), -1, np.float32)
    for k, p in enumerate(pages):
        x[:len(p), k] = p
        mask[:len(p), k] = 1
        if labels is not None:
            y[:len(p), k] = labels[k]
    return x, mask, y


def framed_page(r: np.random.Generator, long: list[str], short: list[str]) -> tuple[list[Block], list[int]]:
    """A page made of sample texts in one of many frames, with its true labels."""
    out: list[Block] = []
    truth: list[int] = []
    pick = lambda xs: xs[int(r.integers(len(xs)))]
    clip = lambda t: " ".join(t.split()[:int(r.integers(2, 40))]) or t
    top = ("html", "body") + (pick([(), ("div",), ("div", "i.wrapper"), ("div", "c.page"), ("div", "i.main", "div")]))

    def add(path: tuple[str, ...], text: str, label: int, link: bool = False) -> None:
        if text:
            out.append(Block(top + path, text, len(text) if link else 0))
            truth.append(label)

    def other(kind: str, base: tuple[str, ...] = ()) -> None:
        name = pick([("c." + kind,), ("i." + kind,), ("c." + kind, "c.box")])
        tag = pick(["div", "section", "aside", "div"])
        for _ in range(int(r.integers(1, 5))):
            inner = pick([(), ("p",), ("ul", "li"), ("div", "p"), ("h3",)])
            text = pick(long) if kind.startswith("comment") and r.random() < 0.6 else clip(pick(long + short))
            add(base + (tag, *name, *inner), text, 0, r.random() < 0.3)

    if r.random() < 0.5:
        add(("header",) + pick([(), ("h1",), ("div", "c.logo"), ("p",)]), clip(pick(short)), 0)
    if r.random() < 0.8:
        nav = pick([("nav", "ul", "li", "a"), ("div", "c.menu", "ul", "li", "a"), ("header", "nav", "a"), ("ul", "c.nav", "li", "a")])
        for _ in range(int(r.integers(2, 9))):
            add(nav, pick(short).split()[0], 0, True)
    for kind in r.choice(OTHER_NAMES, int(r.integers(0, 3))):
        other(str(kind))
    main = pick([("article",), ("main",), ("main", "article"), ("div", "i.content"), ("div", "c.post", "c.content"),
                 ("div", "c.entry", "c.content"), ("section", "c.article", "c.body"), ("div", "r.main"), ("div", "c.story"),
                 ("div", "c.article"), ("td",), ("div",), ("article", "div", "c.text"), ("article", "section")])
    if r.random() < 0.8:
        add(main + pick([("h1",), ("header", "h1"), ("h2",)]), clip(pick(long)), 1)
    for _ in range(int(r.integers(1, 12))):
        inner = pick([("p",)] * 8 + [("p", "b"), ("blockquote", "p"), ("ul", "li"), ("h2",), ("pre",), ("div", "p"), ("div",)])
        add(main + inner, pick(long) if r.random() < 0.8 else clip(pick(long)), 1)
        if r.random() < 0.06:
            other(str(pick(["ad", "advert", "related", "share", "promo", "newsletter"])), main)
    for kind in r.choice(OTHER_NAMES, int(r.integers(0, 3))):
        other(str(kind), main if r.random() < 0.2 else ())
    if r.random() < 0.35:
        other(pick(["comments", "comment"]), main if r.random() < 0.3 else ())
    if r.random() < 0.3:
        for _ in range(int(r.integers(1, 4))):
            add(pick([("aside",), ("div", "c.sidebar")]) + pick([("p",), ("ul", "li", "a"), ("h3",)]), clip(pick(long)), 0)
    if r.random() < 0.25:
        add(("form",) + pick([("label",), ("p",), ("div",)]), clip(pick(short)), 0)
    if r.random() < 0.8:
        add(("footer",) + pick([(), ("p",), ("div", "c.copyright")]), clip(pick(long)), 0)
    return out, truth


def fit(pages: list[str | None], seed: int = 5) -> Labeller:
    """Train a labeller on the pages of a sample."""
    model = Labeller()
    parsed = [b for b in map(blocks, pages) if b]
    if not parsed:
        return model
    signs = [np.array([-1 if (s := sign(b.path)) is None else s for b in p], np.float32) for p in parsed]
    long = [b.text for p, y in zip(parsed, signs, strict=True) for b, s in zip(p, y, strict=True) if s == 1]
    short = [b.text for p, y in zip(parsed, signs, strict=True) for b, s in zip(p, y, strict=True) if s == 0]
    every = [b.text for p in parsed for b in p]
    r = np.random.default_rng(seed)
    made = [framed_page(r, long or every, short or every) for _ in range(FRAMES)]
    made = [(p, y) for p, y in made if p]
    model.train(vectors(parsed + [p for p, _ in made]), signs + [np.array(y, np.float32) for _, y in made])
    return model


def main_text(page: list[Block], chosen: np.ndarray) -> str:
    return "\n\n".join(b.text for b, c in zip(page, chosen, strict=True) if c)


def _extractor(shared) -> Callable:
    def extract(batches):
        model = shared.value
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                parsed = [blocks(h) for h in part.column("html").to_pylist()]
                texts = [main_text(p, c) for p, c in zip(parsed, model.label(parsed), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])
    return extract


def extract_pages(pages: DataFrame) -> DataFrame:
    """(``page_id``, ``url``, ``text``, ``n_chars``) for every row of ``pages``; map-side only after the fit."""
    # a hash draws about the sample's size first, so that no task sends a full sample of its own
    share = int((1 << 30) * min(1.0, 1.5 * TRAIN_PAGES / max(1, pages.count())))
    drawn = (pages.where("html <> ''")
             .select(F.substring("html", 1, TRAIN_CHARS).alias("html"), F.xxhash64("html").alias("h")))
    for most in (share, 1 << 30):                             # all hashes, if the few distinct pages missed the draw
        sample = (drawn.where(F.pmod("h", F.lit(1 << 30)) < most).dropDuplicates(["h"])
                  .orderBy("h").limit(TRAIN_PAGES).collect())
        if sample:
            break
    model = fit([r["html"] for r in sample])
    shared = pages.sparkSession.sparkContext.broadcast(model)
    return pages.select("page_id", "url", "html").mapInArrow(
        _extractor(shared), "page_id long, url string, text string, n_chars long")


def op7_html_extraction(spark, sf_dir) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))
