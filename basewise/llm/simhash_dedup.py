"""SimHash near-duplicates, searched by pigeonring chains (operator 7).

A fingerprint of 64 bits is cut into five ring segments.  If two fingerprints
differ in at most ``radius`` = 4 bits, then some segment starts a chain whose
cumulative differences stay within the proportional budgets floor(l * 4 / 5) =
0, 1, 2, 3, 4 for l = 1..5.  The first two links of the chain are an equi-key:
segment i equal, segment i+1 equal or equal but for one bit.  The remaining
links prune the pairs that share a key; the last link is the full Hamming
check.  Keys are made of distinct fingerprints only, so copies cost nothing.

Defined results: null and empty texts have no words and fingerprint zero,
which links like any other; repeated rows and repeated doc_ids each keep their
row; a null doc_id gets a result but never names a component unless the
component has no other id (component_id is then null); an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basewise.llm.common import BROADCAST_ROWS, attached, components, small, written

WIDTHS = (13, 13, 13, 13, 12)
STARTS = (0, 13, 26, 39, 52)
RADIUS = 4
#: A key's budget after 1..5 links of the chain.
BUDGETS = tuple(RADIUS * n // len(WIDTHS) for n in range(1, len(WIDTHS) + 1))
#: The mark of a key whose second segment is whole.
WHOLE = 15
#: Keys shared by more fingerprints than this give a spanning forest.
PAIRS_UP_TO = 8
BLOCK = 1 << 15
#: Fingerprints whose keys one task makes.
DEALT = 16_384


def fingerprint(text: str | None, words: int = 4) -> int:
    """Majority bits of the shingles' XXH64, as an unsigned integer."""
    import xxhash

    held = (text or "").encode("utf-8").lower().split()
    if not held:
        return 0
    n = max(1, len(held) - words + 1)
    hash64, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, n, BLOCK):
        end = min(n, at + BLOCK)
        h = np.fromiter((hash64(b" ".join(held[i : i + words]), 42) for i in range(at, end)), np.uint64, end - at)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, words: int = 4) -> DataFrame:
    """(doc_id, text) -> (doc_id, fp), fp the fingerprint as a signed long."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = np.fromiter((fingerprint(t.as_py(), words) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(got.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(make, "doc_id long, fp long")


def _keys(fp: Column) -> Column:
    """The 70 chain keys: 5 starts x (second segment whole or but for a bit)."""
    part = [F.shiftrightunsigned(fp, s).bitwiseAND(F.lit((1 << w) - 1)) for s, w in zip(STARTS, WIDTHS, strict=True)]
    out = []
    for i in range(5):
        first, second = part[i], part[(i + 1) % 5]
        head = F.shiftleft(first, 13)
        for bit in (WHOLE, *range(WIDTHS[(i + 1) % 5])):
            tail = second if bit == WHOLE else second.bitwiseAND(F.lit(~(1 << bit)))
            out.append(head.bitwiseOR(tail).bitwiseOR(F.lit((i * 16 + bit) << 26)))
    return F.array(*out)


def _chained(a: np.ndarray, b: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Whether the ring chain from each pair's start keeps all its budgets."""
    x = a ^ b
    parts = np.stack([np.bitwise_count((x >> np.uint64(s)) & np.uint64((1 << w) - 1)) for s, w in zip(STARTS, WIDTHS, strict=True)])
    total, fits, rows = np.zeros(len(x), np.int64), np.ones(len(x), bool), np.arange(len(x))
    for n, budget in enumerate(BUDGETS):
        total += parts[(start + n) % 5, rows]
        fits &= total <= budget
    return fits


def _forest(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that span the linked groups among fps, at most len(fps) - 1."""
    left, out_a, out_b = fps, [], []
    while len(left):
        front, left = [left[0]], left[1:]
        while front and len(left):
            u = front.pop()
            near = np.bitwise_count(left ^ u) <= RADIUS
            if near.any():
                found = left[near]
                out_a.append(np.full(len(found), u))
                out_b.append(found)
                front.extend(found)
                left = left[~near]
    none = np.zeros(0, np.uint64)
    return np.concatenate([none, *out_a]), np.concatenate([none, *out_b])


def _links(keys: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links among fingerprints that share a key; keys are sorted."""
    edge = np.flatnonzero(np.diff(keys)) + 1
    start, end = np.r_[0, edge], np.r_[edge, len(keys)]
    size = end - start
    many = np.flatnonzero(size > 1)
    if not len(many):
        none = np.zeros(0, np.uint64)
        return none, none
    bit, ring = (keys[start] >> 26) & 15, keys[start] >> 30
    # Where no two members differ in the free bit, the whole key has the pairs.
    free = (np.array(STARTS)[(ring + 1) % 5] + np.where(bit == WHOLE, 0, bit)).astype(np.uint64)
    ones = np.add.reduceat(((fps >> np.repeat(free, size)) & np.uint64(1)).astype(np.int64), start)
    many = many[((bit == WHOLE) | ((ones > 0) & (ones < size)))[many]]
    ring = ring[many]
    out_a, out_b = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
    few = size[many] <= PAIRS_UP_TO
    s, n, r = start[many[few]], size[many[few]], ring[few]
    for i in range(PAIRS_UP_TO):
        for j in range(i + 1, PAIRS_UP_TO):
            has = n > j
            if not has.any():
                break
            a, b = fps[s[has] + i], fps[s[has] + j]
            ok = _chained(a, b, r[has])
            out_a.append(a[ok])
            out_b.append(b[ok])
    for g in many[~few]:
        a, b = _forest(fps[start[g] : end[g]])
        out_a.append(a)
        out_b.append(b)
    return np.concatenate(out_a), np.concatenate(out_b)


def links(distinct: DataFrame) -> DataFrame:
    """(fp) distinct -> (a, b): links that keep all groups connected.

    Up to eight fingerprints that share a key give each of their links; more
    give links that span the same groups, so no group emits all its pairs.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps = np.zeros(0, np.int64), np.zeros(0, np.uint64)

        def told(k: np.ndarray, f: np.ndarray) -> Iterator[pa.RecordBatch]:
            if len(k):
                a, b = _links(k, f)
                if len(a):
                    pair = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(pair[0]), pa.array(pair[1])], ["a", "b"])

        for batch in batches:
            keys = np.r_[keys, batch.column(0).to_numpy(zero_copy_only=False)]
            fps = np.r_[fps, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)]
            if not len(keys) or keys[0] == keys[-1]:
                continue
            cut = np.searchsorted(keys, keys[-1], "left")
            yield from told(keys[:cut], fps[:cut])
            keys, fps = keys[cut:], fps[cut:]
        yield from told(keys, fps)

    # Fingerprints are few and their keys are many: the work is dealt by count.
    dealt = distinct.repartition(max(1, -(-distinct.count() // DEALT)))
    keyed = dealt.select(F.explode(_keys(F.col("fp"))).alias("k"), "fp")
    return keyed.repartition("k").sortWithinPartitions("k").mapInArrow(find, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, words: int = 4) -> DataFrame:
    """(doc_id, text) -> (doc_id, fp, component_id) by whole texts."""
    fps = written(fingerprints(docs, words), "fingerprints")
    classes = written(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n")), "classes")
    root = components(links(classes.select("fp")))
    # A linked fingerprint's root; the root itself is nobody's node.
    ends = small(root.select("node", "root").union(root.select("root", "root").distinct()), "roots", BROADCAST_ROWS)
    linked = classes.join(ends, classes.fp == ends.node, "left").select("fp", "first_id", "n", "root")
    named = linked.where("root is not null").groupBy("root").agg(F.min("first_id").alias("least"))
    named = small(named, "named", BROADCAST_ROWS).withColumnRenamed("root", "group")
    told = linked.join(named, F.col("root") == F.col("group"), "left").select("fp", "n", F.when(F.col("root").isNull(), F.col("first_id")).otherwise(F.col("least")).alias("component_id"))
    return attached(fps, written(told, "named"), "fp", fps.count()).select("doc_id", "fp", "component_id")


def op7_simhash(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, fingerprint, component_id."""
    return near_duplicates(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
