"""Near-duplicates by shingle similarity, candidates by wide SimHash chains
(operator 7, for a similarity in place of a radius).

At a similarity of 0.8 some 15 % of a SimHash's bits differ, which no index of
64 bits reaches.  So the fingerprint has 512 bits here, and it is laid out on
rings: seeded orders of its bits.  On each ring a chain of consecutive segments
is followed.  Its first segment must be equal: it is the key that candidates
meet by.  After each further segment of 16 bits the cumulative difference must
stay within BUDGET of the bits so far.  What passes is held to the exact Jaccard
similarity of the texts' shingles, and only what reaches it is linked.

A key has as many bits as the number of distinct texts asks for, so that about
one unrelated text shares it, and there are so many rings that a pair at the
threshold shares a key with a chance of RECALL; more similar pairs nearly
always do (README has measured figures).  Rings grow with the power 0.24 of the
number of texts.

Up to eight texts that share a key give each of their pairs; of more, each is
paired with the leaders of the key, texts that no earlier leader's chain
reaches: a group of copies never emits all its pairs, and a task holds the
leaders and one block of rows.

What chance and the leaders leave out is found exactly in a second pass.  All
shingles have one order, and two texts of the similarity share one of the first
n - ceil(similarity * n) + 1 of either's n distinct shingles.  Texts of different
components, as the chains' links leave them, that meet by such a shingle, and
whose sizes and places in the order allow the similarity, are held to it as well.
So no link between components is left out, and a group of copies, one component
by then, gives no pair.  Any order gives the same links; rare shingles come first,
as counted on some ORDERED texts, so that few texts meet.

Before texts are read again, pairs of either pass are held to their texts'
signatures: a bit for the parity of the distinct shingles that fall on it.  Two
texts' signatures differ in no more bits than shingles are in one text alone, so
the bound loses no link, and few pairs under a similarity of 0.7 pass it.  Only
for what passes are whole sets of shingles moved.

Defined results: words are those of operator 7; texts of the same words are
equal, those of null and empty texts and of white space alone among them; under
five words the whole sequence is the one shingle; of each group the row with the
smallest doc_id stays, null ones last, of repeated rows one; an empty table
gives an empty result; all columns stay, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basewise.llm.common import BROADCAST_ROWS, attached, components, small, written

WORDS, SIMILARITY = 5, 0.8
LANES, RECALL, BUDGET = 8, 0.97, 0.25
BITS, LINK, LINKS = 64 * LANES, 16, 4
#: Key bits at least and at most.
LEAST, MOST = 12, 30
PAIRS_UP_TO, BLOCK = 8, 1 << 15
#: Texts whose keys one task makes.
DEALT = 16_384
#: Texts whose shingles are counted for their order, about, and shingles that are counted as frequent, at most.
ORDERED, FREQUENT = 16_384, 100_000
#: Texts of one shingle from which those outside its largest component are taken one by one.
MANY = 64
#: Words whose hashes a task remembers.
REMEMBERED = 500_000
ODD = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)
SALT = np.arange(1, LANES + 1, dtype=np.uint64) * ODD[0]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * ODD[1]
    x = (x ^ (x >> np.uint64(27))) * ODD[2]
    return x ^ (x >> np.uint64(31))


class Words:
    """Hashes of words, remembered."""

    def __init__(self) -> None:
        import xxhash

        self.hash, self.known = xxhash.xxh64_intdigest, {}

    def of(self, text: str | None) -> np.ndarray:
        """The hashes of a text's words, in order."""
        held, known = (text or "").encode("utf-8").lower().split(), self.known
        if len(known) > REMEMBERED:
            known.clear()
        out = np.empty(len(held), np.uint64)
        for i, w in enumerate(held):
            h = known.get(w)
            if h is None:
                h = known[w] = self.hash(w, 42)
            out[i] = h
        return out


def shingles(words: np.ndarray, size: int = WORDS) -> np.ndarray:
    """A hash of each run of words; of all, if there are fewer."""
    size = min(size, len(words))
    if not size:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(words) - size + 1, np.uint64)
    for i in range(size):
        out = mixed(out * ODD[3] + words[i : len(words) - size + 1 + i] + ODD[4])
    return out


def fingerprint(held: np.ndarray) -> bytes:
    """The majority bits of shingles' hashes in every lane."""
    if not len(held):
        return bytes(BITS // 8)
    ones = np.zeros(BITS, np.int64)
    for s in range(0, len(held), BLOCK):
        lanes = mixed(held[s : s + BLOCK, None] ^ SALT[None, :])
        ones += np.unpackbits(lanes.view(np.uint8).reshape(len(lanes), -1), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return np.packbits(2 * ones > len(held), bitorder="little").tobytes()


def signature(held: np.ndarray) -> bytes:
    """The parity of how many distinct shingles fall on each bit; the bits are a
    power of two, at least as many as the shingles."""
    bits = max(64, 1 << max(len(held) - 1, 0).bit_length())
    ones = np.bincount((held & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(ones.astype(np.uint8), bitorder="little").tobytes()


def folded(rows: np.ndarray, size: int) -> np.ndarray:
    """Signatures, a row each, in so many bytes."""
    while rows.shape[1] > size:
        half = rows.shape[1] // 2
        rows = rows[:, :half] ^ rows[:, half:]
    return rows


def near_enough(n: np.ndarray, x: pa.Array, m: np.ndarray, y: pa.Array, similarity: float) -> np.ndarray:
    """Whether texts of n and m shingles can be of the similarity, by their
    signatures."""
    fits, sizes = np.zeros(len(n), bool), np.stack([pc.binary_length(c).to_numpy(zero_copy_only=False) for c in (x, y)], axis=1)
    for both in np.unique(sizes, axis=0):
        at = np.flatnonzero((sizes == both).all(1))
        a, b = (np.frombuffer(b"".join(c.take(pa.array(at)).to_pylist()), np.uint8).reshape(len(at), -1) for c in (x, y))
        alone = np.bitwise_count(folded(a, both.min()) ^ folded(b, both.min())).sum(1, dtype=np.int64)
        total = n[at] + m[at]
        fits[at] = total - alone >= 2 * similarity / (1 + similarity) * total - 1e-6
    return fits


def layout(texts: int, similarity: float = SIMILARITY) -> tuple[int, int]:
    """Key bits and rings for so many distinct texts."""
    bits = int(np.clip(np.ceil(np.log2(max(texts, 2))), LEAST, MOST))
    same = 1 - np.arccos(2 * similarity / (1 + similarity)) / np.pi
    return bits, int(np.ceil(-np.log(1 - RECALL) / same**bits))


def rings(bits: int, count: int) -> np.ndarray:
    """The bits of each ring's chain, in order: the key's, then the links'."""
    rng = np.random.default_rng(2024)
    return np.stack([rng.permutation(BITS)[: bits + LINK * LINKS] for _ in range(count)])


def chained(a: np.ndarray, b: np.ndarray, bits: int) -> np.ndarray:
    """Whether the links behind an equal key keep their budgets."""
    x, total, fits = a ^ b, 0, True
    for n in range(LINKS):
        total = total + np.bitwise_count((x >> np.uint64(LINK * n)) & np.uint64((1 << LINK) - 1))
        fits = fits & (total <= int(BUDGET * (bits + LINK * (n + 1))))
    return fits


class Leaders:
    """Pairs the texts of one key with its leaders, as many blocks as come."""

    def __init__(self, bits: int, out: list[tuple[np.ndarray, np.ndarray]]) -> None:
        self.bits, self.out, self.key = bits, out, None
        self.nodes: list[int] = []
        self.chains: list[np.uint64] = []

    def take(self, keys: np.ndarray, nodes: np.ndarray, chains: np.ndarray) -> None:
        """Rows of one key; those no leader reaches become leaders in their turn."""
        if keys[0] != self.key:
            self.key, self.nodes, self.chains = keys[0], [], []
        at = 0
        while len(nodes):
            if at == len(self.nodes):
                self.nodes.append(nodes[0])
                self.chains.append(chains[0])
                nodes, chains = nodes[1:], chains[1:]
            reached = chained(self.chains[at], chains, self.bits)
            self.out.append((np.full(int(reached.sum()), self.nodes[at]), nodes[reached]))
            nodes, chains = nodes[~reached], chains[~reached]
            at += 1


def _pairs(keys: np.ndarray, nodes: np.ndarray, chains: np.ndarray, led: Leaders) -> None:
    """The pairs of whole keys; keys are sorted."""
    edge = np.r_[0, np.flatnonzero(np.diff(keys)) + 1, len(keys)] if len(keys) else np.zeros(1, np.int64)
    size, at = np.diff(edge), edge[:-1]
    few = (size > 1) & (size <= PAIRS_UP_TO) & (keys[at] != led.key if led.key is not None else True)
    start, n = at[few], size[few]
    for i in range(PAIRS_UP_TO):
        for j in range(i + 1, PAIRS_UP_TO):
            has = n > j
            x, y = start[has] + i, start[has] + j
            ok = chained(chains[x], chains[y], led.bits)
            led.out.append((nodes[x][ok], nodes[y][ok]))
    for g in np.flatnonzero(~few & ((size > 1) | (keys[at] == led.key if led.key is not None else False))):
        led.take(keys[edge[g] : edge[g + 1]], nodes[edge[g] : edge[g + 1]], chains[edge[g] : edge[g + 1]])


def _prints(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, k, node, fp, m, sig): a text's raw hash, that of its words, its
    bits, its distinct shingles and their signature."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Words()
        for batch in batches:
            node, m, fp, sig = np.empty(batch.num_rows, np.int64), np.empty(batch.num_rows, np.int64), [], []
            for i, text in enumerate(batch.column(2)):
                held = known.of(text.as_py())
                node[i] = known.hash(held.tobytes(), 1) - (1 << 63)
                fp.append(fingerprint(held := shingles(held, words)))
                m[i] = len(held := np.unique(held))
                sig.append(signature(held))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(node), pa.array(fp, pa.binary()), pa.array(m), pa.array(sig, pa.binary())], ["doc_id", "k", "node", "fp", "m", "sig"])

    return _texts(docs).mapInArrow(make, "doc_id long, k long, node long, fp binary, m long, sig binary")


def _texts(docs: DataFrame) -> DataFrame:
    """(doc_id, k, text): k tells texts apart."""
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64(text).alias("k"), text.alias("text"))


def _candidates(texts: DataFrame, bits: int, count: int) -> DataFrame:
    """(node, fp) -> (a, b), a < b: pairs whose chain passes on some ring."""
    orders = rings(bits, count)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.int64(1) << np.arange(bits, dtype=np.int64)
        for whole in batches:
            for s in range(0, whole.num_rows, 4096):
                batch = whole.slice(s, 4096)
                node = batch.column(0).to_numpy(zero_copy_only=False)
                held = np.unpackbits(np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(-1, BITS // 8), axis=1, bitorder="little")
                for t, order in enumerate(orders):
                    part = held[:, order]
                    key = part[:, :bits].astype(np.int64) @ weights + (np.int64(t) << MOST)
                    chain = np.ascontiguousarray(np.packbits(part[:, bits:], axis=1, bitorder="little")).view(np.int64)[:, 0]
                    yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(node), pa.array(chain)], ["key", "node", "chain"])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[np.ndarray, np.ndarray]] = []
        rows = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))
        led = Leaders(bits, out)

        def told() -> pa.RecordBatch:
            a, b = (np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 2
            out.clear()
            pair = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
            return pa.RecordBatch.from_arrays([pa.array(pair[0]), pa.array(pair[1])], ["a", "b"])

        for batch in batches:
            new = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            rows = tuple(np.concatenate(x) for x in zip(rows, (new[0], new[1], new[2].view(np.uint64)), strict=True))
            # The last key may go on; only a long one is begun before its end.
            cut = np.searchsorted(rows[0], rows[0][-1], "left") if len(rows[0]) else 0
            _pairs(*(x[:cut] for x in rows), led)
            rows = tuple(x[cut:] for x in rows)
            if len(rows[0]) > BLOCK:
                led.take(*rows)
                rows = tuple(x[:0] for x in rows)
            if sum(len(x) for x, _ in out) >= 100_000:
                yield told()
        _pairs(*rows, led)
        yield told()

    dealt = texts.select("node", "fp").repartition(max(1, -(-texts.count() // DEALT)))
    keyed = dealt.mapInArrow(keys, "key long, node long, chain long")
    return keyed.repartition("key").sortWithinPartitions("key", "node").mapInArrow(find, "a long, b long").distinct()


def _shingled(docs: DataFrame, asked: DataFrame, words: int) -> DataFrame:
    """(node, s): the distinct shingles of the texts asked for by k."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Words()
        for batch in batches:
            got = [np.unique(shingles(known.of(t.as_py()), words)).view(np.int64) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.list_(pa.int64()))], ["node", "s"])

    rows = _texts(docs).join(asked, "k").groupBy("node").agg(F.first("text").alias("text"))
    return rows.mapInArrow(make, "node long, s array<long>")


def _frequent(docs: DataFrame, total: int, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that come in several of some ORDERED texts, sorted, and in how
    many: they come last in the order of all shingles."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen = Words(), set()
        for batch in batches:
            got = [np.zeros(0, np.uint64)]
            for k, text in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
                if k not in seen:
                    seen.add(k)
                    got.append(np.unique(shingles(known.of(text.as_py()), words)))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(got).view(np.int64))], ["s"])

    some = _texts(docs).where(F.pmod("k", F.lit(max(1, total // ORDERED))) == 0).mapInArrow(make, "s long")
    rows = some.groupBy("s").agg(F.count(F.lit(1)).alias("n")).where("n > 2").orderBy(F.desc("n"), "s").limit(FREQUENT).collect()
    held = np.array([(r.s, r.n) for r in rows], np.int64).reshape(-1, 2)
    s, n = np.ascontiguousarray(held[:, 0]).view(np.uint64), held[:, 1]
    at = np.argsort(s)
    return s[at], n[at]


def prefix(held: np.ndarray, frequent: tuple[np.ndarray, np.ndarray], similarity: float) -> np.ndarray:
    """The first of sorted distinct shingles, by the order of all: as many as
    must hold one of any text of the similarity."""
    size = len(held) - int(np.ceil(similarity * len(held) - 1e-9)) + 1 if len(held) else 0
    known, counts = frequent
    if not len(known):
        return held[:size]
    at = np.minimum(np.searchsorted(known, held), len(known) - 1)
    n = np.where(known[at] == held, counts[at], 0)
    return held[np.lexsort((held, n))[:size]]


def allowed(n: np.ndarray, place: np.ndarray, m: np.ndarray, other: np.ndarray, similarity: float) -> np.ndarray:
    """Whether texts of n and m shingles that first meet at these places can be
    of the similarity."""
    least = similarity / (1 + similarity) * (n + m) - 1e-6
    return (np.minimum(n, m) >= similarity * np.maximum(n, m) - 1e-6) & (np.minimum(n - place, m - other) >= least)


def met(keys: np.ndarray, nodes: np.ndarray, parts: np.ndarray, n: np.ndarray, place: np.ndarray, similarity: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs of different parts (components) of whole keys that sizes and
    places allow; rows are sorted by key, then n."""
    if not len(keys):
        return
    edge = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    size = np.diff(np.r_[edge, len(keys)])
    mixed_ = np.minimum.reduceat(parts, edge) != np.maximum.reduceat(parts, edge)
    # Few texts: each row with the one so many rows on, while any is in reach.
    few = np.repeat(mixed_ & (size <= MANY), size)
    at, on = np.flatnonzero(few), 1
    while len(at):
        at = at[at + on < len(keys)]
        at = at[(keys[at] == keys[at + on]) & (n[at] >= similarity * n[at + on] - 1e-6)]
        to = at + on
        ok = (parts[at] != parts[to]) & allowed(n[at], place[at], n[to], place[to], similarity)
        yield nodes[at[ok]], nodes[to[ok]]
        on += 1
    for g in np.flatnonzero(mixed_ & (size > MANY)):
        rows = slice(edge[g], edge[g] + size[g])
        node, part, m, other = nodes[rows], parts[rows], n[rows], place[rows]
        names, counts = np.unique(part, return_counts=True)
        outside = part != names[np.argmax(counts)]
        for i in np.flatnonzero(outside):
            lo, hi = np.searchsorted(m, similarity * m[i] - 1e-6), np.searchsorted(m, m[i] / similarity + 1e-6, "right")
            near = np.arange(lo, hi)
            near = near[(part[lo:hi] != part[i]) & (~outside[lo:hi] | (near > i)) & allowed(m[lo:hi], other[lo:hi], m[i], other[i], similarity)]
            yield np.full(len(near), node[i]), node[near]


def _left_out(docs: DataFrame, roots: DataFrame, total: int, words: int, similarity: float) -> DataFrame:
    """(a, b), a < b: every pair of texts of different components that can be of
    the similarity."""
    frequent = _frequent(docs, total, words)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen = Words(), set()
        for batch in batches:
            node, n, first = [], [], []
            for text in batch.column(2):
                held = known.of(text.as_py())
                name = known.hash(held.tobytes(), 1) - (1 << 63)
                if name in seen:
                    continue
                seen.add(name)
                held = np.unique(shingles(held, words))
                node.append(name)
                n.append(len(held))
                first.append(prefix(held, frequent, similarity).view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(n, pa.int32()), pa.array(first, pa.list_(pa.int64()))], ["node", "n", "first"])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[np.ndarray, np.ndarray]] = []
        rest: list[list[np.ndarray]] = []

        def told() -> pa.RecordBatch:
            a, b = (np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 2
            out.clear()
            pair = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
            return pa.RecordBatch.from_arrays([pa.array(pair[0]), pa.array(pair[1])], ["a", "b"])

        def whole(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            held = 0
            for a, b in met(*rows, similarity):
                out.append((a, b))
                held += len(a)
                if held >= 100_000:
                    yield told()
                    held = 0
            yield told()

        for batch in batches:
            new = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
            if not len(new[0]):
                continue
            rest.append(new)
            # The last key may go on.
            if new[0][-1] != rest[0][0][0]:
                rows = [np.concatenate(x) for x in zip(*rest, strict=True)]
                cut = np.searchsorted(rows[0], rows[0][-1], "left")
                yield from whole([x[:cut] for x in rows])
                rest = [[x[cut:] for x in rows]]
        if rest:
            yield from whole([np.concatenate(x) for x in zip(*rest, strict=True)])

    of = roots.select("of", "component")
    held = _texts(docs).mapInArrow(make, "node long, n int, first array<long>").join(of, F.col("node") == F.col("of"), "left")
    keyed = held.select("node", F.coalesce("component", "node").alias("part"), "n", F.posexplode("first").alias("place", "key")).select("key", "node", "part", "n", "place")
    return keyed.repartition("key").sortWithinPartitions("key", "n").mapInArrow(find, "a long, b long").distinct()


def _possible(texts: DataFrame, pairs: DataFrame, similarity: float) -> DataFrame:
    """Those of the pairs (a, b) that can be of the similarity by their texts'
    signatures."""

    def hold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = (batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 4))
            yield batch.select(["a", "b"]).filter(pa.array(near_enough(n, batch.column(3), m, batch.column(5), similarity)))

    mine, theirs = (texts.select(F.col("node").alias(c), F.col("m").alias(f"m{c}"), F.col("sig").alias(f"sig{c}")) for c in "ab")
    return pairs.join(mine, "a").join(theirs, "b").select("a", "b", "ma", "siga", "mb", "sigb").mapInArrow(hold, "a long, b long")


def _links(docs: DataFrame, texts: DataFrame, pairs: DataFrame, words: int, similarity: float) -> DataFrame:
    """Those of the pairs (a, b), written, that are of the similarity."""
    # Pairs are few, and so are the texts that have to be read again.
    side = F.broadcast if 2 * pairs.count() <= BROADCAST_ROWS else (lambda df: df)
    nodes = side(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct())
    asked = side(texts.select("node", "k").join(nodes, "node", "left_semi"))
    held = small(_shingled(docs, asked, words), "shingles", BROADCAST_ROWS, 1 << 21, "size(s)")
    mine, theirs = (held.select(F.col("node").alias(c), F.col("s").alias(f"s{c}")) for c in "ab")
    both = pairs.join(mine, "a").join(theirs, "b").select("a", "b", F.size(F.array_intersect("sa", "sb")).alias("both"), (F.size("sa") + F.size("sb")).alias("all"))
    return both.where(F.col("both") >= F.lit(similarity) * (F.col("all") - F.col("both"))).select("a", "b")


def _roots(links: DataFrame) -> DataFrame:
    return small(components(links), "roots", BROADCAST_ROWS).withColumnsRenamed({"node": "of", "root": "component"})


def similar(docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, text) -> (doc_id, k, node, component): component is the same for
    rows whose texts are linked by pairs of the similarity or more."""
    prints = written(_prints(docs, words), "prints")
    told = (F.first(c).alias(c) for c in ("fp", "m", "sig"))
    texts = written(prints.groupBy("node").agg(*told, F.min("k").alias("k"), F.count(F.lit(1)).alias("n")), "texts")
    met_ = written(_candidates(texts, *layout(texts.count(), similarity)), "candidates")
    pairs = written(_possible(texts, met_, similarity), "possible")
    links = written(_links(docs, texts, pairs, words, similarity), "links")
    roots, total = _roots(links), prints.count()
    met_ = written(_left_out(docs, roots, total, words, similarity), "left_out")
    more = written(_possible(texts, met_, similarity), "possible")
    roots = _roots(links.union(_links(docs, texts, more, words, similarity)))
    named = texts.join(roots, F.col("node") == F.col("of"), "left").select("node", "n", F.coalesce("component", "node").alias("component"))
    return attached(prints.select("doc_id", "k", "node"), written(named, "named"), "node", total)


def one_of_each_group(docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """One row of each group of near-duplicates; all columns stay."""
    rows = written(similar(docs, words, similarity), "groups")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "k")
    groups = rows.groupBy("component").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    kept = small(groups.select(F.col("component").alias("of"), "first"), "first", BROADCAST_ROWS)
    beside = rows.withColumn("place", place).join(kept, F.col("component") == F.col("of"))
    lost = small(beside.where(F.col("place") != F.col("first")).select("doc_id", "k").distinct(), "lost", BROADCAST_ROWS)
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    same = lambda df: docs["doc_id"].cast("long").eqNullSafe(df["doc_id"]) & (F.xxhash64(text) == df["k"])
    stays = docs.join(lost, same(lost), "left_anti")
    # Rows that repeat a doc_id and a text: nearly always none.
    twice = small(rows.groupBy("doc_id", "k").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id", "k"), "twice", BROADCAST_ROWS)
    if not twice.count():
        return stays
    row = F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("row")
    again = docs.join(lost, same(lost), "left_anti").join(twice, same(twice), "left_semi")
    one = again.select(docs["doc_id"].cast("long").alias("i"), F.xxhash64(text).alias("k"), row).groupBy("i", "k").agg(F.first("row").alias("row"))
    return stays.join(twice, same(twice), "left_anti").unionByName(one.select(*(F.col("row").getField(c).alias(c) for c in docs.columns)))
