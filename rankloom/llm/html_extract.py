"""Main text of web pages by a recurrent block labeller.

A page is a sequence of leaf blocks. Each block's input is its hashed tag path (elements and class words
of all open elements), its hashed words, its length and its share of linked characters. A bidirectional
LSTM reads the sequence both ways, so every block is labelled with the whole page in view; the
blocks labelled as article are joined.

It is trained on pages of two kinds: a bounded sample of the table, labelled by the roles of the
open elements (``role_label``), and skeleton pages drawn from the same roles, which also show layouts
that the sample lacks. Training pages are told by structure only; the labeller then decides alone.

Defined results: null and empty pages, and pages without an article block, give an empty text; a repeated
row is extracted each time. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.llm.html_blocks import Block, leaf_blocks
from rankloom.llm.textbatch import passes, prepare, sample, span_hashes, spread, text_buffers, word_spans

SAMPLE_PAGES = 300
SAMPLE_CHARS = 100_000
SKELETONS = 700
#: Blocks of a training page (the labeller reads pages of any length).
TRAINING_BLOCKS = 80
PATH_SLOTS, WORD_SLOTS, EXTRAS, HIDDEN = 1024, 32, 3, 16
EPOCHS, BATCH, RATE = 10, 32, 0.01
#: Blocks of pages decoded together.
DECODED = 4_000

# What element names and class words say about a block.
NOT_ARTICLE_ELEMENTS = frozenset("nav header footer aside form menu dialog button fieldset".split())
NOT_ARTICLE_WORDS = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright "
    "disclaimer disqus footer header login menu nav navbar navigation newsletter notice notices pagination popup promo promoted "
    "promotion related reply replies respond search share sidebar signup social sponsor sponsored subscribe toolbar warning widget".split()
)
ARTICLE_ELEMENTS = ("article", "main")
ARTICLE_WORDS = ("content", "article", "post", "entry", "story", "body", "main", "text")
NEUTRAL_WORDS = ("wrap", "row", "col", "page", "site", "container", "inner", "left", "top", "x1", "block", "section")


def role_label(path: tuple[str, ...], page_has_article: bool) -> bool:
    """Whether the open elements make a block part of the article."""
    if any(name in NOT_ARTICLE_ELEMENTS or (name[0] == "." and name[1:] in NOT_ARTICLE_WORDS) for name in path):
        return False
    return not page_has_article or any(name in ARTICLE_ELEMENTS for name in path)


def skeleton(random: np.random.Generator) -> tuple[list[Block], list[bool]]:
    """A page of random regions and filler words, with its labels."""

    def pick(options):
        return options[int(random.integers(len(options)))]

    def text(low: int, high: int) -> str:
        return " ".join(f"w{random.integers(100_000)}" for _ in range(int(random.integers(low, high))))

    off_words = sorted(NOT_ARTICLE_WORDS)
    blocks: list[Block] = []
    labels: list[bool] = []
    outer = ("html", "body", *(("div", "." + pick(NEUTRAL_WORDS)) if random.random() < 0.4 else ()))

    def add(path: tuple[str, ...], words: str, linked: float, label: bool) -> None:
        blocks.append(Block(words, path, linked))
        labels.append(label)

    def aside_region(base: tuple[str, ...], count: int) -> None:
        if random.random() < 0.5:
            region: tuple[str, ...] = (pick(sorted(NOT_ARTICLE_ELEMENTS)),)
        else:
            region = (pick(("div", "section", "ul", "p", "span", "table")), "." + pick(off_words))
            if random.random() < 0.2:
                region = (*region, "." + pick(NEUTRAL_WORDS))
        style = random.random()
        for _ in range(count):
            inner = ("ul", "li") if style < 0.3 else ("p",) if style < 0.6 else ("div",) if style < 0.75 else ()
            add((*base, *region, *inner), text(1, 6) if random.random() < 0.6 else text(6, 60), float(random.random() < 0.5), False)

    for _ in range(int(random.integers(0, 4))):
        aside_region(outer, int(random.integers(1, 9)))
    style = random.random()
    if style < 0.65:
        holder: tuple[str, ...] = (pick(ARTICLE_ELEMENTS),)
    elif style < 0.9:
        holder = ("div", "." + pick(ARTICLE_WORDS))
    else:
        holder = ()
    if random.random() < 0.3:
        holder = (*holder, "div", "." + pick(NEUTRAL_WORDS))
    article = (*outer, *holder)
    add((*article, pick(("h1", "h2", "p", "h1"))), text(1, 14), 0.0, True)
    for _ in range(int(random.integers(1, 20))):
        inner = pick((("p",), ("p",), ("p",), ("p",), ("h2",), ("ul", "li"), ("blockquote", "p"), ("table", "tr", "td"), ("pre",), (), ("figure", "figcaption"), ("section", "p")))
        add((*article, *inner), text(1, 6) if random.random() < 0.3 else text(4, 90), float(random.random() < 0.06), True)
        if random.random() < 0.05:
            aside_region(article, int(random.integers(1, 4)))
    if random.random() < 0.25:
        aside_region(article, int(random.integers(1, 4)))
    for _ in range(int(random.integers(0, 4))):
        aside_region(outer, int(random.integers(1, 6)))
    return blocks, labels


def path_vector(path: tuple[str, ...]) -> np.ndarray:
    out = np.zeros(PATH_SLOTS)
    for name in path:
        out[zlib.crc32(name.encode()) % PATH_SLOTS] = 1
    return out


def word_vectors(texts: list[str]) -> np.ndarray:
    """Hashed, signed words of each text over the root of their number, then size and word length."""
    data, bounds = text_buffers(pa.array(texts, pa.large_string()))
    starts, ends, first = word_spans(data, bounds)
    value = span_hashes(data, starts, ends)
    row = spread(first)
    count = np.diff(first)
    place = (value % np.uint64(WORD_SLOTS)).astype(np.int64)
    sums = np.bincount(row * WORD_SLOTS + place, weights=np.where(value >> np.uint64(63), 1.0, -1.0), minlength=len(texts) * WORD_SLOTS)
    vectors = sums.reshape(len(texts), WORD_SLOTS) / np.sqrt(np.maximum(count, 1))[:, None]
    size = np.log1p(count) / 5
    return np.column_stack((0.2 * vectors, size, np.diff(bounds) / np.maximum(count, 1) / 20))


@dataclass
class Labeller:
    """Input, recurrent and output weights of both directions; gates in the order in, forget, out, new."""

    inputs: list[np.ndarray]
    recurrent: list[np.ndarray]
    bias: list[np.ndarray]
    out: np.ndarray
    base: np.ndarray

    def parameters(self) -> list[np.ndarray]:
        return [*self.inputs, *self.recurrent, *self.bias, self.out, self.base]

    def label(self, pages: list[list[Block]]) -> list[np.ndarray]:
        """Article or not, for every block of every page."""
        labels: list[np.ndarray] = [np.zeros(len(page), bool) for page in pages]
        order = sorted((i for i, page in enumerate(pages) if page), key=lambda i: len(pages[i]))
        projected: dict[tuple[str, ...], list[np.ndarray]] = {}
        at = 0
        while at < len(order):
            to = at + 1
            while to < len(order) and (to + 1 - at) * len(pages[order[to]]) <= DECODED:
                to += 1
            chosen = [pages[i] for i in order[at:to]]
            logits = self._logits(chosen, projected)
            for k, i in enumerate(order[at:to]):
                labels[i] = logits[: len(pages[i]), k] > 0
            at = to
        return labels

    def _logits(self, pages: list[list[Block]], projected: dict) -> np.ndarray:
        flat = [block for page in pages for block in page]
        for block in flat:
            if block.path not in projected:
                if len(projected) > 20_000:
                    projected.clear()
                vector = path_vector(block.path)
                projected[block.path] = [vector @ w[:PATH_SLOTS] + b for w, b in zip(self.inputs, self.bias, strict=True)]
        dense = np.column_stack((word_vectors([b.text for b in flat]), [b.linked for b in flat]))
        size = np.array([len(page) for page in pages])
        column = np.repeat(np.arange(len(pages)), size)
        step = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
        paths: dict[tuple[str, ...], int] = {}
        which = np.array([paths.setdefault(b.path, len(paths)) for b in flat])
        total = np.full((int(size.max()), len(pages)), float(self.base[0]))
        for d in (0, 1):
            table = np.array([projected[path][d] for path in paths])
            z = np.zeros((int(size.max()), len(pages), 4 * HIDDEN))
            z[step, column] = table[which] + dense @ self.inputs[d][PATH_SLOTS:]
            states, _ = _run(z, self.recurrent[d], size, backward=bool(d))
            total += states @ self.out[d * HIDDEN : (d + 1) * HIDDEN]
        return total


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _run(z: np.ndarray, recurrent: np.ndarray, size: np.ndarray, backward: bool) -> tuple[np.ndarray, list]:
    """Hidden states of all steps; a page's state stays zero outside its blocks."""
    steps, pages, _ = z.shape
    h, c = np.zeros((pages, HIDDEN)), np.zeros((pages, HIDDEN))
    states, trace = np.zeros((steps, pages, HIDDEN)), []
    for t in range(steps - 1, -1, -1) if backward else range(steps):
        live = (size > t)[:, None]
        a = z[t] + h @ recurrent
        gates = _sigmoid(a[:, : 3 * HIDDEN])
        i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
        g = np.tanh(a[:, 3 * HIDDEN :])
        before_h, before_c = h, c
        c = np.where(live, f * c + i * g, 0)
        bent = np.tanh(c)
        h = np.where(live, o * bent, 0)
        states[t] = h
        trace.append((t, live, i, f, o, g, bent, before_h, before_c))
    return states, trace


def _back(slope: np.ndarray, trace: list, recurrent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the gate inputs (as z) and of the recurrent weights."""
    dz, dw = np.zeros((*slope.shape[:2], 4 * HIDDEN)), np.zeros_like(recurrent)
    dh, dc = np.zeros(slope.shape[1:]), np.zeros(slope.shape[1:])
    for t, live, i, f, o, g, bent, before_h, before_c in reversed(trace):
        dh = np.where(live, dh + slope[t], 0)
        dc = np.where(live, dc + dh * o * (1 - bent**2), 0)
        da = np.concatenate((dc * g * i * (1 - i), dc * before_c * f * (1 - f), dh * bent * o * (1 - o), dc * i * (1 - g**2)), axis=1)
        dz[t] = da
        dw += before_h.T @ da
        dh, dc = da @ recurrent.T, dc * f
    return dz, dw


def train(pages: list[list[Block]], labels: list[list[bool]], seed: int = 9) -> Labeller:
    """Adam on the logistic loss of all blocks."""
    random = np.random.default_rng(seed)
    width = PATH_SLOTS + WORD_SLOTS + EXTRAS
    bias = np.zeros(4 * HIDDEN)
    bias[HIDDEN : 2 * HIDDEN] = 1
    net = Labeller(
        [random.normal(0, 0.1, (width, 4 * HIDDEN)) for _ in (0, 1)], [random.normal(0, 0.2, (HIDDEN, 4 * HIDDEN)) for _ in (0, 1)],
        [bias.copy(), bias.copy()], random.normal(0, 0.3, 2 * HIDDEN), np.zeros(1),
    )
    x = [
        np.column_stack((np.array([path_vector(b.path) for b in page]), word_vectors([b.text for b in page]), [b.linked for b in page]))
        for page in pages
    ]
    first = [np.zeros_like(p) for p in net.parameters()]
    second = [np.zeros_like(p) for p in net.parameters()]
    turn = 0
    for _ in range(EPOCHS):
        order = random.permutation(len(pages))
        order = order[np.argsort([len(pages[i]) // 8 for i in order], kind="stable")]  # batches of like length
        batches = [order[i : i + BATCH] for i in range(0, len(order), BATCH)]
        for k in random.permutation(len(batches)):
            size = np.array([len(pages[i]) for i in batches[k]])
            block = np.concatenate([x[i] for i in batches[k]])
            truth = np.concatenate([labels[i] for i in batches[k]]).astype(float)
            column = np.repeat(np.arange(len(size)), size)
            step = np.arange(len(block)) - np.repeat(np.cumsum(size) - size, size)
            runs = []
            total = np.full(len(block), float(net.base[0]))
            for d in (0, 1):
                z = np.zeros((int(size.max()), len(size), 4 * HIDDEN))
                z[step, column] = block @ net.inputs[d] + net.bias[d]
                states, trace = _run(z, net.recurrent[d], size, backward=bool(d))
                runs.append((states, trace))
                total += states[step, column] @ net.out[d * HIDDEN : (d + 1) * HIDDEN]
            error = (_sigmoid(total) - truth) / len(truth)
            slopes: list[list[np.ndarray]] = [[], [], []]
            out = []
            for d in (0, 1):
                states, trace = runs[d]
                out.append(states[step, column].T @ error)
                slope = np.zeros_like(states)
                slope[step, column] = error[:, None] * net.out[d * HIDDEN : (d + 1) * HIDDEN]
                dz, dw = _back(slope, trace, net.recurrent[d])
                flat = dz[step, column]
                for place, value in zip(slopes, (block.T @ flat, dw, flat.sum(0)), strict=True):
                    place.append(value)
            turn += 1
            grads = [*slopes[0], *slopes[1], *slopes[2], np.concatenate(out), np.array([error.sum()])]
            for p, grad, m, v in zip(net.parameters(), grads, first, second, strict=True):
                m += 0.1 * (grad - m)
                v += 0.01 * (grad**2 - v)
                p -= RATE * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.99**turn)) + 1e-7)
    return net


def training_pages(pages: list[str], seed: int = 13) -> tuple[list[list[Block]], list[list[bool]]]:
    blocks, labels = [], []
    for page in pages:
        found = leaf_blocks(page)
        has = any(name in ARTICLE_ELEMENTS for block in found for name in block.path)
        found = found if len(found) <= TRAINING_BLOCKS else found[: TRAINING_BLOCKS // 2] + found[-TRAINING_BLOCKS // 2 :]
        if found:
            blocks.append(found)
            labels.append([role_label(block.path, has) for block in found])
    random = np.random.default_rng(seed)
    for _ in range(SKELETONS):
        page, label = skeleton(random)
        blocks.append(page[:TRAINING_BLOCKS])
        labels.append(label[:TRAINING_BLOCKS])
    return blocks, labels


def fit(pages: DataFrame, *, page_id: str = "page_id", html: str = "html") -> Labeller:
    prepare(pages.sparkSession)
    source = pages.select(F.col(page_id).alias("id"), F.col(html).alias("html")).filter(F.length("html") <= SAMPLE_CHARS)
    rows = sample(source, SAMPLE_PAGES, "id", "html").collect()
    return train(*training_pages(sorted(row.html for row in rows)))


def main_text(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    labeller = fit(pages, page_id=page_id, html=html)
    source = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in passes(batch, "html"):
                found = [leaf_blocks(page or "") for page in part.column(2).to_pylist()]
                texts = [
                    "\n".join(block.text for block, keep in zip(page, labels, strict=True) if keep)
                    for page, labels in zip(found, labeller.label(found), strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"],
                )

    return source.mapInArrow(run, "page_id long, url string, text string, n_chars long")
