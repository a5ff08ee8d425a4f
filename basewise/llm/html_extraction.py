"""Main text of web pages by a linear-chain CRF over DOM blocks (operator 1).

A page becomes a chain of leaf blocks.  Each block has features of its ancestor
tags, of their class, id and role names, and of its text; a linear-chain
conditional random field over {main, rest} scores chains of labels from the
features and the transitions, and Viterbi decodes the best.  It is trained in
numpy, by the gradient of the conditional likelihood (forward-backward), on
TRAINED labelled pages that PageMaker writes from a fixed seed; the training is
the same wherever it runs.

The text of the main blocks: character references decoded, white space within a
block made one space, trimmed, joined in page order by one space.

Defined results: a null or empty page, or one without main text, gives the
empty string and 0; broken markup is read as far as it goes; repeated rows keep
their rows; a null page_id or url stays null; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basewise.llm.html_blocks import Block, Place, blocks
from basewise.llm.labelled_pages import NAMES, PageMaker, labelled

TRAINED, SEED, STEPS, RATE, DECAY = 600, 2024, 80, 0.1, 1e-4
BITS = 13
AT_ONCE = 64
WORDS = {
    "nav": "home menu about contact",
    "notice": "cookie cookies privacy consent javascript",
    "form": "subscribe newsletter email login search password",
    "legal": "copyright rights reserved terms imprint",
    "ad": "advertisement sponsored offer",
    "side": "related popular tags recommended",
    "comment": "comment comments reply says report",
    "share": "share tweet facebook follow print",
}
CUES = {w: kind for kind, told in WORDS.items() for w in told.split()}
SPLIT = re.compile(r"[^a-z]+")
PARTS = {kind: frozenset(p for name in names for p in SPLIT.split(name) if len(p) > 1) for kind, names in NAMES.items()}
_KINDS = {part: tuple(kind for kind, parts in PARTS.items() if part in parts) for parts in PARTS.values() for part in parts}
ROLES = frozenset("navigation banner contentinfo complementary search main article form dialog alert".split())
KNOWN = ROLES | frozenset(_KINDS)


@functools.lru_cache(maxsize=100_000)
def _id(told: str) -> int:
    return zlib.crc32(told.encode("utf-8")) >> (32 - BITS)


@functools.lru_cache(maxsize=50_000)
def _place(place: Place) -> tuple[int, ...]:
    """Features of the ancestors, remembered: blocks share their place."""
    told = {f"tag {t}" for t in place.tags}
    told.add(f"leaf {place.leaf[-1] if place.leaf else ''}")
    told.add(f"above {' '.join(place.leaf)}")
    told.update(f"kind {kind}" for part in place.names for kind in _KINDS.get(part, ()))
    told.update(f"near {kind}" for part in place.near for kind in _KINDS.get(part, ()))
    told.update(f"role {part}" for part in place.names & ROLES)
    if place.hidden:
        told.add("hidden")
    if place.inner:
        told.add("article, then " + place.inner)
    return tuple(sorted(_id(x) for x in told))


def _told(block: Block, at: float, first: bool, last: bool) -> list[int]:
    text = block.text
    n = text.count(" ") + 1
    share = block.linked / max(len(text), 1)
    told = [
        f"words {min(n.bit_length(), 8)}",
        f"links {int(share * 4)}",
        f"link count {min(block.parts, 3)}",
        f"ends {text[-1] if text[-1] in '.!?:,' else ''}",
        f"at {int(at * 5)}",
        "any",
    ]
    if first:
        told.append("first")
    if last:
        told.append("last")
    if "©" in text:
        told.append("copyright mark")
    if n <= 12:
        told.extend({f"cue {CUES[w]}" for w in (x.strip(".,:!?") for x in text.lower().split(" ")) if w in CUES})
    return [_id(x) for x in told]


def page_features(held: list[Block]) -> list[tuple[int, ...]]:
    n = len(held)
    return [(*_place(b.place), *_told(b, i / n, i == 0, i == n - 1)) for i, b in enumerate(held)]


class CRF:
    """Two labels a block; scores are linear in hashed features."""

    def __init__(self) -> None:
        self.weights = np.zeros((1 << BITS, 2))
        self.step = np.zeros((2, 2))
        self.start = np.zeros(2)

    def scores(self, pages: list[list[tuple[int, ...]]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Padded emissions (page, place, label), lengths, and the flat ids."""
        sizes = np.array([len(p) for p in pages])
        counts = np.array([len(f) for p in pages for f in p])
        ids = np.fromiter((x for p in pages for f in p for x in f), np.int64, int(counts.sum()))
        flat = np.add.reduceat(self.weights[ids], np.r_[0, np.cumsum(counts)[:-1]])
        out = np.zeros((len(pages), int(sizes.max()), 2))
        out[np.repeat(np.arange(len(pages)), sizes), np.arange(len(counts)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
        return out, sizes, ids, counts

    def viterbi(self, pages: list[list[tuple[int, ...]]]) -> list[np.ndarray]:
        """The best labels of each page; all pages have blocks."""
        emit, sizes, _, _ = self.scores(pages)
        n, most, _ = emit.shape
        best, back = emit[:, 0] + self.start, np.zeros((n, most, 2), np.int64)
        for t in range(1, most):
            via = best[:, :, None] + self.step[None]
            back[:, t] = via.argmax(1)
            live = (t < sizes)[:, None]
            best = np.where(live, via.max(1) + emit[:, t], best)
        out, label = np.zeros((n, most), np.int64), best.argmax(1)
        for t in range(most - 1, -1, -1):
            live = t < sizes
            out[live, t] = label[live]
            if t:
                label = np.where(live, back[np.arange(n), t, label], label)
        return [row[:k] for row, k in zip(out, sizes, strict=True)]

    def train(self, pages: list[list[tuple[int, ...]]], labels: list[np.ndarray], steps: int = STEPS) -> CRF:
        """Adam on the whole sample's conditional log-likelihood."""
        held = [self.weights, self.step, self.start]
        m, v = [np.zeros_like(a) for a in held], [np.zeros_like(a) for a in held]
        total = sum(map(len, pages))
        for k in range(1, steps + 1):
            for a, g, b, c in zip(held, self._gradient(pages, labels, total), m, v, strict=True):
                g = g - DECAY * a
                b += 0.1 * (g - b)
                c += 0.01 * (g * g - c)
                a += RATE * (b / (1 - 0.9**k)) / (np.sqrt(c / (1 - 0.99**k)) + 1e-8)
        return self

    def _gradient(self, pages: list[list[tuple[int, ...]]], labels: list[np.ndarray], total: int) -> list[np.ndarray]:
        emit, sizes, ids, counts = self.scores(pages)
        n, most, _ = emit.shape
        live = np.arange(most)[None] < sizes[:, None]
        add = lambda x, axis: np.logaddexp.reduce(x, axis=axis)
        fore, rear = np.zeros_like(emit), np.zeros_like(emit)
        fore[:, 0] = emit[:, 0] + self.start
        for t in range(1, most):
            got = add(fore[:, t - 1][:, :, None] + self.step[None], 1) + emit[:, t]
            fore[:, t] = np.where(live[:, t, None], got, fore[:, t - 1])
        for t in range(most - 2, -1, -1):
            got = add(self.step[None] + (emit[:, t + 1] + rear[:, t + 1])[:, None, :], 2)
            rear[:, t] = np.where(live[:, t + 1, None], got, 0)
        z = add(fore[:, -1], 1)
        p = np.exp(fore + rear - z[:, None, None]) * live[:, :, None]
        truth = np.zeros_like(emit)
        for i, y in enumerate(labels):
            truth[i, np.arange(len(y)), y] = 1
        diff = (truth - p)[live]
        weights = np.stack([np.bincount(ids, weights=np.repeat(diff[:, y], counts), minlength=1 << BITS) for y in (0, 1)], 1)
        both = live[:, 1:]
        edge = fore[:, :-1, :, None] + self.step + (emit + rear)[:, 1:, None, :] - z[:, None, None, None]
        step = (truth[:, :-1, :, None] * truth[:, 1:, None, :])[both].sum(0) - np.exp(edge[both]).sum(0)
        return [weights / total, step / total, (truth[:, 0] - p[:, 0]).sum(0) / total]


def training_pages(n: int = TRAINED, seed: int = SEED) -> tuple[list[list[tuple[int, ...]]], list[np.ndarray]]:
    """Features and labels of the blocks of n written pages."""
    pages, labels = [], []
    for i in range(n):
        held, y = [], []
        for block in blocks(PageMaker(seed + i).page(), KNOWN):
            block.text, label = labelled(block.text)
            if block.text.strip():
                held.append(block)
                y.append(label)
        if held:
            pages.append(page_features(held))
            labels.append(np.array(y))
    return pages, labels


def trained() -> CRF:
    return CRF().train(*training_pages())


def extract(model: CRF, pages: list[str | None]) -> list[str]:
    """The main text of each page."""
    held = [blocks(p, KNOWN) for p in pages]
    asked = [i for i, b in enumerate(held) if b]
    out = [""] * len(pages)
    if asked:
        for i, labels in zip(asked, model.viterbi([page_features(held[i]) for i in asked]), strict=True):
            out[i] = " ".join(b.text for b, y in zip(held[i], labels, strict=True) if y)
    return out


def main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, html) -> (page_id, url, text, n_chars)."""
    model = pages.sparkSession.sparkContext.broadcast(trained())

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in range(0, batch.num_rows, AT_ONCE):
                part = batch.slice(s, AT_ONCE)
                texts = extract(model.value, part.column(2).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(make, "page_id long, url string, text string, n_chars long")


def op1_extract(pages: DataFrame) -> DataFrame:
    return main_text(pages)
