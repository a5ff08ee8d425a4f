"""Toxicity by non-negative positive-unlabelled learning (operator 8).

A linear classifier over the distinct words of a text and their beginnings,
hashed, is trained in numpy from confirmed toxic texts and unlabelled texts.
With class prior p and the sigmoid loss l, the risk is
p E+[l(z)] + max(0, Eu[l(-z)] - p E+[l(-z)]): the second term estimates the
risk of the texts that aren't toxic, and where it would turn negative, as it
does from overfitting, it is zero and moves nothing.  Only features that stand
out in the toxic sample against the unlabelled one, and that the other texts,
by the prior, hold at most half as often, get a weight: so a long clean text
gathers no score from its length (README has the figures without this screen).
Copies of a text count once in the samples.

Labels are learnt only from documents that aren't held out, from bounded
samples by hash order: POSITIVE toxic texts and UNLABELLED texts of any kind.
The prior is a parameter; unless given it is the share of toxic texts, copies
once, among those whose labels are learnt from.  The cut is the
one with the greatest recall less twice the share of the other texts called
toxic, estimated without negatives; scores are shifted to have it at 0.7.

Defined results: null and empty texts get the score of no word; repeated rows
keep their rows; repeated or contradicting labels count as they come, null
labels not at all; a null doc_id has a null held_out and trains nothing; with
no toxic label every score is 0; where no cut is worth more than calling
nothing toxic, as with too few toxic texts for any feature to stand out,
nothing is called toxic; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basewise.llm.common import BROADCAST_ROWS, small, written
from basewise.llm.language_id import remainder

POSITIVE, UNLABELLED = 4000, 8000
BITS, STARTS = 18, (3, 4, 5, 6)
STEPS, RATE, DECAY = 300, 0.05, 1e-5
#: A feature is learnt from so many positive texts at least, so many standard
#: errors above the unlabelled.
LEAST, STANDS_OUT = 4, 3.87
#: How often the other texts hold a feature, at most, to once in the toxic.
OTHERS = 0.5
CUT, COST = 0.7, 2.0
WORD = re.compile(r"[^\W\d_]+")
REMEMBERED = 200_000


def word_features(word: str) -> tuple[int, ...]:
    """Hashed features of a word: itself and its beginnings."""
    told = [f"={word}", *(f"^{word[:n]}" for n in STARTS if len(word) >= n)]
    return tuple(zlib.crc32(x.encode("utf-8")) >> (32 - BITS) for x in told)


def features(text: str | None) -> np.ndarray:
    """The distinct features of a text's distinct words."""
    held = {f for w in set(WORD.findall((text or "").lower())) for f in word_features(w)}
    return np.array(sorted(held), np.int32)


@dataclass
class Model:
    #: Weights of the features that told positive from unlabelled texts.
    weights: dict[int, float]
    bias: float
    cut: float
    scale: float

    def score(self, z: np.ndarray) -> np.ndarray:
        at = self.scale * (z - self.cut) + np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(at, -40, 40)))


def screened(toxic: Column, unlabelled: Column, n: int, u: int, prior: float) -> Column:
    """Whether a feature that so many of n toxic and u unlabelled texts hold
    stands out by a two-sample test, and isn't common in the other texts."""
    a, c = toxic / F.lit(n), unlabelled / F.lit(u)
    share = (toxic + unlabelled) / F.lit(n + u)
    z = (a - c) / F.sqrt(F.greatest(share * (1 - share) * F.lit(1 / n + 1 / u), F.lit(1e-12)))
    others = F.greatest(c - F.lit(prior) * a, F.lit(0.0)) / F.lit(max(1 - prior, 1e-9))
    return (toxic >= LEAST) & (z > STANDS_OUT) & (others <= OTHERS * a)


def risk(z: np.ndarray, n: int, prior: float) -> tuple[float, float]:
    """Two parts of the risk at logits z, of which the first n are positive: that
    of the toxic texts, and the estimate for all others, which can be negative."""
    s = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    return prior * (1 - s[:n]).mean(), s[n:].mean() - prior * s[:n].mean()


def slopes(z: np.ndarray, n: int, prior: float) -> np.ndarray:
    """Of the non-negative risk, by logit: a negative second part is zero."""
    s = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    slope, u = s * (1 - s), len(z) - n
    if risk(z, n, prior)[1] >= 0:
        return np.r_[-2 * prior * slope[:n] / n, slope[n:] / u]
    return np.r_[-prior * slope[:n] / n, np.zeros(u)]


def fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], kept: np.ndarray, prior: float, steps: int = STEPS) -> Model:
    """Non-negative PU learning by Adam on the sigmoid loss; texts hold features
    of kept, which ascends."""
    held = [np.searchsorted(kept, x) for x in positive + unlabelled]
    n, u, k = len(positive), len(unlabelled), len(kept)
    ids, own = np.concatenate(held).astype(np.int64), np.repeat(np.arange(n + u), [len(x) for x in held])
    w = np.zeros(k + 1)
    w[k] = -1.0  # the bias
    m, v = np.zeros(k + 1), np.zeros(k + 1)
    logits = lambda: w[k] + np.bincount(own, weights=w[ids], minlength=n + u)
    for step in range(1, steps + 1):
        g = slopes(logits(), n, prior)
        grad = np.r_[np.bincount(ids, weights=g[own], minlength=k) + DECAY * w[:k], g.sum()]
        m += 0.1 * (grad - m)
        v += 0.001 * (grad * grad - v)
        w -= RATE * np.sqrt(1 - 0.999**step) / (1 - 0.9**step) * m / (np.sqrt(v) + 1e-8)
    z = logits()
    # The greatest recall less COST times the share of other texts called toxic,
    # which the prior tells from the unlabelled texts.
    cuts = np.unique(z)
    # The last cut, of worth 0, calls nothing toxic.
    cuts = np.append((cuts[1:] + cuts[:-1]) / 2, np.inf)
    above = lambda x: len(x) - np.searchsorted(np.sort(x), cuts)
    recall = above(z[:n]) / n
    worth = recall - COST * (above(z[n:]) / u - prior * recall) / max(1 - prior, 1e-9)
    return Model(dict(zip(kept.tolist(), w[:k].tolist(), strict=True)), float(w[k]), float(cuts[int(worth.argmax())]), 1.0)


def train(docs: DataFrame, labels: DataFrame, positive: int = POSITIVE, unlabelled: int = UNLABELLED, prior: float | None = None) -> Model | None:
    """(doc_id, text), (doc_id, toxic) -> a model, from bounded samples."""
    open_ = remainder("doc_id", 3) != 1
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic").where(open_ & F.col("toxic").isNotNull())
    hashed = docs.select(F.col("doc_id").alias("__id"), F.xxhash64("text").alias("__text"))
    texts = hashed.join(known, F.col("__id") == F.col("doc_id")).groupBy("__text").agg(F.max(F.col("toxic").cast("double")).alias("toxic"))
    share = texts.agg(F.avg("toxic")).first()[0]
    if not share:
        return None
    prior = share if prior is None else prior
    by_hash = lambda df, n: df.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    chosen = by_hash(known.where("toxic = 1"), positive).withColumn("p", F.lit(True))
    chosen = chosen.unionByName(by_hash(docs.where(open_), unlabelled).withColumn("p", F.lit(False)))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [features(t.as_py()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(got, pa.list_(pa.int32()))], ["doc_id", "p", "f"])

    rows = docs.join(F.broadcast(chosen.withColumnRenamed("doc_id", "__id")), F.col("doc_id") == F.col("__id")).select("doc_id", "p", "text")
    # Features stay on the executors: only those that pass the screen are fetched.
    told = rows.mapInArrow(make, "doc_id long, p boolean, f array<int>").withColumn("h", F.xxhash64("f"))
    told = written(told.groupBy("p", "h").agg(F.min("doc_id").alias("doc_id"), F.first("f").alias("f")), "features")
    n, u = told.agg(F.count_if("p"), F.count_if(~F.col("p"))).first()
    if not n or not u:
        return None
    by = told.select("p", F.explode("f").alias("f")).groupBy("f").agg(F.count_if("p").alias("a"), F.count_if(~F.col("p")).alias("c"))
    kept = np.array(sorted(r.f for r in by.where(screened(F.col("a"), F.col("c"), n, u, float(prior))).select("f").collect()), np.int32)
    few = F.array(*(F.lit(int(x)) for x in kept)).cast("array<int>")
    held = told.select("p", "doc_id", "h", F.array_sort(F.array_intersect("f", few)).alias("f")).toArrow().sort_by([("p", "descending"), ("doc_id", "ascending"), ("h", "ascending")])
    texts = [np.asarray(x.values, np.int32) for x in held.column("f")]
    return fit(texts[:n], texts[n:], kept, float(prior))


def scorer(model: Model | None) -> Callable[[pa.Array], np.ndarray]:
    """Scores of whole texts; words met before are remembered."""
    known: dict[str, tuple[int, ...]] = {}

    def of(texts: pa.Array) -> np.ndarray:
        scores = np.zeros(len(texts))
        if model is None:
            return scores
        weights = model.weights
        for i, text in enumerate(texts):
            live: set[int] = set()
            for word in set(WORD.findall((text.as_py() or "").lower())):
                got = known.get(word)
                if got is None:
                    got = tuple(f for f in word_features(word) if f in weights)
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[word] = got
                if got:
                    live.update(got)
            scores[i] = model.bias + sum(weights[f] for f in sorted(live))
        return model.score(scores)

    return of


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of docs."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = scorer(model.value)
        for batch in batches:
            scores = score(batch.column(2))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores), pa.array((scores >= CUT).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select("doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "text")
    return rows.mapInArrow(make, "doc_id long, held_out boolean, score double, predicted int")


def op8_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return scored(docs, labels)


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows whose text isn't called toxic; all columns stay.

    Each row is judged by its own text, so rows that share a doc_id with a toxic
    one stay.  Only texts' hashes leave the scorer, and nothing is shuffled where
    the toxic ones are few enough to broadcast.
    """
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    key = [F.xxhash64(text), F.crc32(text.cast("binary"))]
    held = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text.alias("text"))
    model = docs.sparkSession.sparkContext.broadcast(train(held, labels))

    def toxic(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = scorer(model.value)
        for batch in batches:
            told = pa.array(score(batch.column(2)) >= CUT)
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(told) for i in (0, 1)], ["k", "g"])

    rows = docs.select(key[0].alias("k"), key[1].alias("g"), text.alias("text"))
    lost = small(rows.mapInArrow(toxic, "k long, g long").distinct(), "toxic", BROADCAST_ROWS)
    return docs.join(lost, (key[0] == lost["k"]) & (key[1] == lost["g"]), "left_anti")
