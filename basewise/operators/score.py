"""The convolutional scorer of positions: its forward pass and its training.

Weights come from an npz file; without one, positions are skipped (null).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basewise.functions.windows import running_sum
from basewise.operators.masks import SITE
from basewise.operators.tensor import FEATURES

#: Parts of the range of probabilities that are ranked apart.
BUCKETS = 1024

#: Kernel shapes (out, in, samples, features), paddings, layers.
KERNELS = {"conv1": (32, 4, 3, 4), "conv2": (64, 32, 2, 2), "conv3": (128, 64, 2, 2)}
PADS = {"conv1": (1, 1), "conv2": (1, 0), "conv3": (1, 0)}
DENSE = {"fc1": (64, 128), "fc2": (1, 64)}


def random_weights(seed: int = 0) -> dict[str, np.ndarray]:
    """Untrained weights, to test with."""
    rng = np.random.default_rng(seed)
    out = {}
    for name, shape in (KERNELS | DENSE).items():
        out[f"{name}.weight"] = rng.standard_normal(shape) / np.sqrt(np.prod(shape[1:]))
        out[f"{name}.bias"] = rng.standard_normal(shape[0]) * 0.1
    return out


def convolve(x: np.ndarray, weight: np.ndarray, bias: np.ndarray, pad: tuple[int, int]) -> np.ndarray:
    """x: (in, samples, features) -> (out, samples, features)."""
    x = np.pad(x, ((0, 0), (pad[0], pad[0]), (pad[1], pad[1])))
    view = np.lib.stride_tricks.sliding_window_view(x, weight.shape[2:], axis=(1, 2))
    return np.einsum("ishkl,oikl->osh", view, weight, optimize=True) + bias[:, None, None]


def forward(x: np.ndarray, weights: dict[str, np.ndarray]) -> float:
    """The score of one position: x is (4 bases, samples, 8 features)."""
    for name, pad in PADS.items():
        x = np.maximum(convolve(x, weights[f"{name}.weight"], weights[f"{name}.bias"], pad), 0)
    h = x.mean(axis=(1, 2))
    h = np.maximum(weights["fc1.weight"] @ h + weights["fc1.bias"], 0)
    z = float((weights["fc2.weight"] @ h + weights["fc2.bias"])[0])
    return 1 / (1 + np.exp(-z))


def gradients(x: np.ndarray, label: float, weights: dict[str, np.ndarray]) -> tuple[float, dict[str, np.ndarray]]:
    """The cross-entropy of one position and its gradient by every weight."""
    held, views = [], []
    for name, pad in PADS.items():
        x = np.pad(x, ((0, 0), (pad[0], pad[0]), (pad[1], pad[1])))
        weight = weights[f"{name}.weight"]
        view = np.lib.stride_tricks.sliding_window_view(x, weight.shape[2:], axis=(1, 2))
        z = np.einsum("ishkl,oikl->osh", view, weight, optimize=True) + weights[f"{name}.bias"][:, None, None]
        held.append((x.shape, z))
        views.append(view)
        x = np.maximum(z, 0)
    pooled = x.mean(axis=(1, 2))
    first = weights["fc1.weight"] @ pooled + weights["fc1.bias"]
    hidden = np.maximum(first, 0)
    z = float((weights["fc2.weight"] @ hidden + weights["fc2.bias"])[0])
    loss = float(np.logaddexp(0, z) - label * z)
    dz = 1 / (1 + np.exp(-z)) - label
    out = {"fc2.weight": dz * hidden[None, :], "fc2.bias": np.array([dz])}
    back = dz * weights["fc2.weight"][0] * (first > 0)
    out |= {"fc1.weight": np.outer(back, pooled), "fc1.bias": back}
    back = np.broadcast_to((weights["fc1.weight"].T @ back)[:, None, None] / (x.shape[1] * x.shape[2]), x.shape)
    for (name, pad), (shape, z), view in zip(reversed(PADS.items()), reversed(held), reversed(views), strict=True):
        back = back * (z > 0)
        weight = weights[f"{name}.weight"]
        out |= {f"{name}.weight": np.einsum("osh,ishkl->oikl", back, view, optimize=True), f"{name}.bias": back.sum(axis=(1, 2))}
        full = np.zeros(shape)
        for k in range(weight.shape[2]):
            for m in range(weight.shape[3]):
                full[:, k : k + back.shape[1], m : m + back.shape[2]] += np.einsum("osh,oi->ish", back, weight[:, :, k, m])
        back = full[:, pad[0] : shape[1] - pad[0], pad[1] : shape[2] - pad[1]]
    return loss, out


def train(sites: list[np.ndarray], labels: list[int], check: tuple[list[np.ndarray], list[int]], epochs: int = 150, patience: int = 20, rate: float = 1e-3, batch: int = 32, seed: int = 1234) -> dict[str, np.ndarray]:
    """Weights by Adam on the cross-entropy; those with the least loss of the
    checked sites, which stop the training after patience epochs without a gain."""
    rng, weights, step = np.random.default_rng(seed), random_weights(seed), 0
    m, v = ({k: np.zeros_like(w) for k, w in weights.items()} for _ in range(2))
    best, best_loss, since = weights, np.inf, 0
    for _ in range(epochs):
        order = rng.permutation(len(sites))
        for s in range(0, len(order), batch):
            step += 1
            parts = [gradients(sites[i], labels[i], weights)[1] for i in order[s : s + batch]]
            for k in weights:
                g = sum(p[k] for p in parts) / len(parts)
                m[k] += 0.1 * (g - m[k])
                v[k] += 0.001 * (g * g - v[k])
                weights[k] = weights[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
        p = np.clip([forward(x, weights) for x in check[0]], 1e-12, 1 - 1e-12)
        y = np.array(check[1])
        loss = float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean())
        best, best_loss, since = (dict(weights), loss, 0) if loss < best_loss else (best, best_loss, since + 1)
        if since >= patience:
            break
    return best


def score(tensor: DataFrame, weights: dict[str, np.ndarray] | None) -> DataFrame:
    """group_id, p, prob, cnn: a position's samples gathered and scored.

    cnn is 1 over one half; both are null without weights.
    """
    if weights is None:
        return tensor.select(*SITE).distinct().select(*SITE, F.lit(None).cast("double").alias("prob"), F.lit(None).cast("int").alias("cnn"))
    held = tensor.sparkSession.sparkContext.broadcast(weights)
    cell = F.struct("sample_id", "slot", *(F.col(f).cast("double").alias(f) for f in FEATURES))
    sites = tensor.groupBy(*SITE).agg(F.sort_array(F.collect_list(cell)).alias("x"))
    flat = F.flatten(F.transform("x", lambda r: F.array(*(r[f] for f in FEATURES))))

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            out = []
            for row in batch:
                x = np.asarray(row, float).reshape(-1, 4, len(FEATURES)).transpose(1, 0, 2)
                out.append(forward(x, held.value))
            yield pd.Series(out, dtype=float)

    df = sites.select(*SITE, scored(flat).alias("prob"))
    return df.withColumn("cnn", (F.col("prob") > 0.5).cast("int"))


def class_balance(labels: DataFrame) -> DataFrame:
    return labels.groupBy("label").agg(F.count(F.lit(1)).alias("n"))


def evaluation(scored: DataFrame) -> DataFrame:
    """accuracy, precision, recall, f1 and auc of (label, prob).

    auc by rank sums, ties sharing their mean rank.
    """
    hit = lambda a, b: F.count_if((F.col("label") == a) & ((F.col("prob") > 0.5).cast("int") == b))
    by = scored.groupBy("prob").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("label") == 1).alias("pos"))
    below = running_sum(by, F.col("n"), "prob", F.floor(F.col("prob") * BUCKETS), "below")
    ranks = below.withColumn("rank", F.col("below") + (F.col("n") + 1) / 2).agg(F.sum(F.col("rank") * F.col("pos")).alias("s"), F.sum("pos").alias("p"), F.sum(F.col("n") - F.col("pos")).alias("q"))
    counts = scored.agg(hit(1, 1).alias("tp"), hit(0, 1).alias("fp"), hit(1, 0).alias("fn"), hit(0, 0).alias("tn")).join(ranks, how="cross")
    r = lambda a, b: F.try_divide(a.cast("double"), b.cast("double"))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    p, q = F.col("p"), F.col("q")
    return counts.select(r(tp + tn, tp + tn + fp + fn).alias("accuracy"), r(tp, tp + fp).alias("precision"), r(tp, tp + fn).alias("recall"), r(2 * tp, 2 * tp + fp + fn).alias("f1"), r(F.col("s") - p * (p + 1) / 2, p * q).alias("auc"))
