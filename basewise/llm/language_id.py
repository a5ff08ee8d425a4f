"""Language identification by a byte convolutional network (operator 4).

A window of 256 bytes is embedded, convolved with filters of several widths,
max-pooled and classified by a softmax.  A text's windows cover it whole; its
languages are ranked by the mean of their log-probabilities, weighted by bytes.
The network is trained in numpy on the driver from a bounded sample: TRAINED
windows, by hash order, of all windows of SAMPLE labelled documents that aren't
held out, whole texts again.  Only text goes into a prediction.

Defined results: a null text, or one without a letter (of Unicode's category
L), gives ``und`` and score 0; repeated rows keep their rows; a null doc_id is held out if the remainder of
nothing is asked (held_out is null) and never trains; null labels never train;
with no labelled row at all every text is ``und``; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE, TRAINED, LENGTH = 2000, 8000, 256
WIDTHS, FILTERS, EMBED = (2, 3, 4), 16, 8
EPOCHS, BATCH, RATE = 6, 64, 4e-3
#: Windows that go through the network at once.
AT_ONCE = 32


def remainder(doc_id: str, of: int) -> Column:
    """crc32 of the id's text, by a remainder."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % of


def has_letter(text: str | None) -> bool:
    """Whether any character is of Unicode's category L."""
    return any(map(str.isalpha, text or ""))


def windows(data: bytes, length: int = LENGTH) -> np.ndarray:
    """A text's bytes in rows of fixed length, zeros at the end."""
    n = max(1, -(-len(data) // length))
    out = np.zeros(n * length, np.uint8)
    out[: len(data)] = np.frombuffer(data, np.uint8)
    return out.reshape(n, length)


@dataclass
class ByteCNN:
    """Parameters: embedding, a filter bank per width, biases, softmax layer."""

    langs: list[str]
    embed: np.ndarray
    banks: list[np.ndarray]
    biases: list[np.ndarray]
    out: np.ndarray
    bias: np.ndarray

    @classmethod
    def new(cls, langs: list[str], seed: int = 7) -> ByteCNN:
        rng = np.random.default_rng(seed)
        draw = lambda *s, by: (rng.standard_normal(s) / np.sqrt(by)).astype(np.float32)
        banks = [draw(w, EMBED, FILTERS, by=w * EMBED) for w in WIDTHS]
        return cls(langs, draw(256, EMBED, by=1), banks, [np.zeros(FILTERS, np.float32) for _ in WIDTHS], draw(FILTERS * len(WIDTHS), len(langs), by=FILTERS * len(WIDTHS)), np.zeros(len(langs), np.float32))

    def parameters(self) -> list[np.ndarray]:
        return [self.embed, *self.banks, *self.biases, self.out, self.bias]

    def filters(self) -> np.ndarray:
        """All banks as one matrix over the widest filter's embedded bytes."""
        most = max(WIDTHS)
        out = np.zeros((most, EMBED, FILTERS * len(WIDTHS)), np.float32)
        for i, (w, bank) in enumerate(zip(WIDTHS, self.banks, strict=True)):
            out[:w, :, i * FILTERS : (i + 1) * FILTERS] = bank
        return out.reshape(most * EMBED, -1)

    def convolved(self, x: np.ndarray, filters: np.ndarray) -> np.ndarray:
        """Every filter at every place of every window."""
        e, most = self.embed[x], max(WIDTHS)
        places = x.shape[1] - most + 1
        runs = np.lib.stride_tricks.as_strided(e, (len(x), places, most * EMBED), e.strides, writeable=False)
        return (np.ascontiguousarray(runs).reshape(-1, most * EMBED) @ filters).reshape(len(x), places, -1)

    def log_probabilities(self, x: np.ndarray, filters: np.ndarray) -> np.ndarray:
        hidden = np.maximum(self.convolved(x, filters).max(1) + np.concatenate(self.biases), 0)
        z = hidden @ self.out + self.bias
        z -= z.max(1, keepdims=True)
        return z - np.log(np.exp(z).sum(1, keepdims=True))

    def gradients(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        """Of the mean cross-entropy, in the order of parameters()."""
        y_all = self.convolved(x, self.filters())
        place = y_all.argmax(1)
        values = np.take_along_axis(y_all, place[:, None, :], 1)[:, 0] + np.concatenate(self.biases)
        hidden = np.maximum(values, 0)
        z = hidden @ self.out + self.bias
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        p[np.arange(len(y)), y] -= 1
        p /= len(y)
        back = (p @ self.out.T) * (values > 0)
        embed, banks, biases = np.zeros_like(self.embed), [], []
        rows = np.arange(len(x))[:, None]
        for i, (w, bank) in enumerate(zip(WIDTHS, self.banks, strict=True)):
            g = back[:, i * FILTERS : (i + 1) * FILTERS]
            grad = np.zeros_like(bank)
            for k in range(w):
                hit = x[rows, place[:, i * FILTERS : (i + 1) * FILTERS] + k]
                grad[k] = np.einsum("bf,bfe->ef", g, self.embed[hit])
                np.add.at(embed, hit, g[:, :, None] * bank[k].T[None])
            banks.append(grad)
            biases.append(g.sum(0))
        return [embed, *banks, *biases, hidden.T @ p, p.sum(0)]

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, seed: int = 11) -> ByteCNN:
        """Adam over shuffled batches."""
        rng, step = np.random.default_rng(seed), 0
        held = self.parameters()
        m, v = [np.zeros_like(a) for a in held], [np.zeros_like(a) for a in held]
        for _ in range(epochs):
            order = rng.permutation(len(y))
            for s in range(0, len(y), BATCH):
                step += 1
                at = order[s : s + BATCH]
                for a, g, b, c in zip(held, self.gradients(x[at], y[at]), m, v, strict=True):
                    b += 0.1 * (g - b)
                    c += 0.001 * (g * g - c)
                    a -= RATE * (b / (1 - 0.9**step)) / (np.sqrt(c / (1 - 0.999**step)) + 1e-8)
        return self


def predict(model: ByteCNN | None, texts: list[str | None]) -> tuple[list[str], list[float]]:
    """Language and score of each whole text."""
    langs, scores = ["und"] * len(texts), [0.0] * len(texts)
    if model is None:
        return langs, scores
    filters = model.filters()
    asked = [i for i, t in enumerate(texts) if has_letter(t)]
    sums = np.zeros((len(texts), len(model.langs)))
    sizes = np.zeros(len(texts))

    def told(rows: list[np.ndarray], owner: list[np.ndarray], weight: list[np.ndarray]) -> None:
        x, own, by = np.concatenate(rows), np.concatenate(owner), np.concatenate(weight)
        for s in range(0, len(x), AT_ONCE):
            got = model.log_probabilities(x[s : s + AT_ONCE], filters) * by[s : s + AT_ONCE, None]
            np.add.at(sums, own[s : s + AT_ONCE], got)
            np.add.at(sizes, own[s : s + AT_ONCE], by[s : s + AT_ONCE])

    rows, owner, weight, n = [], [], [], 0
    for i in asked:
        data = texts[i].encode("utf-8")
        x = windows(data)
        by = np.full(len(x), float(LENGTH))
        by[-1] = len(data) - LENGTH * (len(x) - 1)
        rows.append(x)
        owner.append(np.full(len(x), i))
        weight.append(by)
        n += len(x)
        if n >= 64 * AT_ONCE:
            told(rows, owner, weight)
            rows, owner, weight, n = [], [], [], 0
    if rows:
        told(rows, owner, weight)
    for i in asked:
        z = sums[i] / sizes[i]
        p = np.exp(z - z.max())
        p /= p.sum()
        langs[i], scores[i] = model.langs[int(p.argmax())], float(min(p.max(), 1.0))
    return langs, scores


def train(docs: DataFrame, sample: int = SAMPLE, trained: int = TRAINED) -> ByteCNN | None:
    """A network from up to trained windows of up to sample labelled documents."""
    known = docs.where((remainder("doc_id", 5) != 0) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    ids = known.select(F.col("doc_id").alias("__id")).distinct().orderBy(F.xxhash64("__id"), "__id").limit(sample)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, lang, text in zip(*batch.columns, strict=True):
                x = windows(text.as_py().encode("utf-8"))
                told = [i for i, row in enumerate(x) if has_letter(row.tobytes().decode("utf-8", "ignore"))]
                for s in range(0, len(told), 4096):
                    at = told[s : s + 4096]
                    columns = [pa.array([key.as_py()] * len(at), pa.int64()), pa.array([lang.as_py()] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array([x[i].tobytes() for i in at], pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang", "at", "x"])

    rows = known.join(F.broadcast(ids), F.col("doc_id") == F.col("__id")).select("doc_id", "lang", "text")
    told = rows.mapInArrow(cut, "doc_id long, lang string, at int, x binary").orderBy(F.xxhash64("doc_id", "at", "x"), "lang").limit(trained)
    held = told.toArrow().sort_by([(c, "ascending") for c in ("lang", "doc_id", "at", "x")])
    if not held.num_rows:
        return None
    names = held.column("lang").to_pylist()
    langs = sorted(set(names))
    x = np.frombuffer(b"".join(held.column("x").to_pylist()), np.uint8).reshape(-1, LENGTH)
    return ByteCNN.new(langs).train(x, np.array([langs.index(name) for name in names]))


def op4_language(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score for every document."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    model = docs.sparkSession.sparkContext.broadcast(train(docs))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in range(0, batch.num_rows, 512):
                part = batch.slice(s, 512)
                langs, scores = predict(model.value, part.column(2).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "text")
    return rows.mapInArrow(make, "doc_id long, held_out boolean, lang_pred string, score double")
