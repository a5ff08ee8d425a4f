"""Document quality by gated-attention multiple-instance learning (operator 9).

A document is a bag of passages of 512 bytes that cover it whole.  A passage is
described by how often each kind of byte follows each other kind, by word
length and by how many of its words repeat; a layer encodes it, and gated
attention, softmax(w . (tanh(V h) * sigmoid(U h))), weighs the passages.  The
weighted representation is scored by a logistic unit.  All of it is learnt in
numpy on the driver from document labels alone, from a bounded sample: SAMPLE
labelled documents that aren't held out, by hash order.

The cut that tells the labels apart best in the sample, both counted alike, is
put at score 0.3.

Defined results: null and empty texts are one empty passage; repeated rows
keep their rows; repeated or contradicting labels train as they come, null
labels not at all; a null doc_id has a null held_out and trains nothing; with
labels of one kind only every score is that label; with none, 1; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basewise.llm.language_id import remainder

SAMPLE, PASSAGE = 4000, 512
HIDDEN, GATE, EPOCHS, BATCH, RATE = 24, 12, 12, 32, 5e-3
CUT = 0.3
#: Bytes by kind; all others, from 128 on, are parts of letters.
KINDS = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t", "\n\r", ".,;:", "!?", "|", "'\"()-")
N = len(KINDS) + 2
KIND = np.full(256, N - 2, np.uint8)
KIND[128:] = N - 1
for _i, _bytes in enumerate(KINDS):
    KIND[list(_bytes.encode())] = _i
WIDTH = N * N + 4


def passages(text: str | None) -> np.ndarray:
    """A row of features for every passage of the text."""
    data = (text or "").encode("utf-8")
    n = max(1, -(-len(data) // PASSAGE))
    out = np.zeros((n, WIDTH), np.float32)
    if not data:
        return out
    kind = KIND[np.frombuffer(data, np.uint8)].astype(np.int64)
    place = np.arange(len(kind)) // PASSAGE
    # A passage's first byte follows the byte before the passage.
    codes = place * N * N + np.concatenate([[4], kind[:-1]]) * N + kind
    sizes = np.bincount(place, minlength=n)
    out[:, : N * N] = np.bincount(codes, minlength=n * N * N).reshape(n, N * N) / sizes[:, None]
    out[:, : N * N] = np.sqrt(out[:, : N * N])
    out[:, N * N] = np.log1p(sizes) / 6
    for i in range(n):
        words = data[i * PASSAGE : (i + 1) * PASSAGE].split()
        if words:
            out[i, N * N + 1] = len(set(words)) / len(words)
            out[i, N * N + 2] = min(sizes[i] / len(words) / 10, 3)
            out[i, N * N + 3] = sum(a == b for a, b in zip(words, words[1:], strict=False)) / len(words)
    return out


@dataclass
class AttentionMIL:
    """Encoder, gated attention and a logistic unit."""

    held: list[np.ndarray]
    cut: float = 0.0

    @classmethod
    def new(cls, seed: int = 5) -> AttentionMIL:
        rng = np.random.default_rng(seed)
        draw = lambda a, b: rng.standard_normal((a, b)) / np.sqrt(a)
        return cls([draw(WIDTH, HIDDEN), np.zeros(HIDDEN), draw(HIDDEN, GATE), draw(HIDDEN, GATE), draw(GATE, 1)[:, 0], draw(HIDDEN, 1)[:, 0], np.zeros(1)])

    def forward(self, x: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
        """x: the passages of all bags; ends: where each bag ends."""
        w, b, v, u, g, out, bias = self.held
        start = np.r_[0, ends[:-1]]
        sizes = ends - start
        h = np.maximum(x @ w + b, 0)
        t, s = np.tanh(h @ v), 1 / (1 + np.exp(-np.clip(h @ u, -40, 40)))
        e = (t * s) @ g
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, start), sizes))
        a = e / np.repeat(np.add.reduceat(e, start), sizes)
        bag = np.add.reduceat(a[:, None] * h, start)
        return bag @ out + bias[0], h, t, s, a, bag, sizes

    def gradients(self, x: np.ndarray, ends: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
        w, b, v, u, g, out, bias = self.held
        z, h, t, s, a, bag, sizes = self.forward(x, ends)
        dz = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y) * weight / len(y)
        dbag = np.repeat(dz[:, None] * out, sizes, 0)
        da = (dbag * h).sum(1)
        mean = np.repeat(np.add.reduceat(a * da, np.r_[0, ends[:-1]]), sizes)
        de = a * (da - mean)
        dt, ds = de[:, None] * g * s * (1 - t * t), de[:, None] * g * t * s * (1 - s)
        dh = (a[:, None] * dbag + dt @ v.T + ds @ u.T) * (h > 0)
        return [x.T @ dh, dh.sum(0), h.T @ dt, h.T @ ds, (t * s).T @ de, bag.T @ dz, np.array([dz.sum()])]

    def train(self, bags: list[np.ndarray], y: np.ndarray, epochs: int = EPOCHS, seed: int = 3) -> AttentionMIL:
        """Adam over shuffled bags; both labels weigh alike."""
        rng, step = np.random.default_rng(seed), 0
        weight = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
        m, v = [np.zeros_like(a) for a in self.held], [np.zeros_like(a) for a in self.held]
        for epoch in range(epochs):
            order = rng.permutation(len(y))
            rate = RATE * (1 - epoch / epochs)
            for s in range(0, len(y), BATCH):
                step += 1
                at = order[s : s + BATCH]
                x = np.concatenate([bags[i] for i in at]).astype(float)
                ends = np.cumsum([len(bags[i]) for i in at])
                for a, g, b, c in zip(self.held, self.gradients(x, ends, y[at], weight[at]), m, v, strict=True):
                    b += 0.1 * (g - b)
                    c += 0.001 * (g * g - c)
                    a -= rate * (b / (1 - 0.9**step)) / (np.sqrt(c / (1 - 0.999**step)) + 1e-8)
        z = self.logits(bags)
        cuts = np.unique(np.quantile(z, np.linspace(0, 1, 401)))
        cuts = (cuts[1:] + cuts[:-1]) / 2 if len(cuts) > 1 else cuts
        worth = [(z[y == 1] >= c).mean() + (z[y == 0] < c).mean() for c in cuts]
        self.cut = float(np.mean(cuts[np.flatnonzero(np.array(worth) >= max(worth) - 1e-9)]))
        return self

    def logits(self, bags: list[np.ndarray]) -> np.ndarray:
        out = []
        for s in range(0, len(bags), 256):
            part = bags[s : s + 256]
            out.append(self.forward(np.concatenate(part).astype(float), np.cumsum([len(x) for x in part]))[0])
        return np.concatenate(out) if out else np.zeros(0)

    def score(self, z: np.ndarray) -> np.ndarray:
        at = z - self.cut + np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(at, -40, 40)))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> AttentionMIL | float:
    """A model, or the one score of all texts where labels are of one kind."""
    known = labels.select(F.col("doc_id").cast("long").alias("__id"), F.col("quality").cast("int").alias("y")).where((remainder("__id", 5) != 0) & F.col("y").isin(0, 1))
    chosen = known.orderBy(F.xxhash64("__id"), "__id", "y").limit(sample)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [passages(t.as_py()).tobytes() for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(got, pa.binary())], ["doc_id", "y", "x"])

    rows = docs.join(F.broadcast(chosen), F.col("doc_id") == F.col("__id")).select("doc_id", "y", "text")
    held = rows.mapInArrow(make, "doc_id long, y int, x binary").toArrow().sort_by([("doc_id", "ascending"), ("y", "ascending")])
    y = np.array(held.column("y").to_pylist(), float)
    if not len(y) or y.min() == y.max():
        return float(y[0]) if len(y) else 1.0
    bags = [np.frombuffer(x.as_py(), np.float32).reshape(-1, WIDTH) for x in held.column("x")]
    return AttentionMIL.new().train(bags, y)


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of docs."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = model.value
        for batch in batches:
            for s in range(0, batch.num_rows, 256):
                part = batch.slice(s, 256)
                if isinstance(held, float):
                    scores = np.full(part.num_rows, held)
                else:
                    scores = held.score(held.logits([passages(t.as_py()) for t in part.column(2)]))
                predicted = (scores >= CUT).astype(np.int32)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(scores), pa.array(predicted)], ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "text")
    return rows.mapInArrow(make, "doc_id long, held_out boolean, score double, predicted int")


def op9_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return scored(docs, labels)
