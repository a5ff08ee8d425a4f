"""Exact top-k inner-product search with a KD-tree per shard (operator 2).

Space is cut into regions by median splits, learnt from a bounded sample of
SAMPLE vectors; every vector goes to its region, and a region of more than a
shard's vectors (copies of one vector, say) is dealt over several shards.  Each
region has the tight box of all its vectors.  A shard's task builds one
KD-tree: median splits on the widest axis, each node with the tight box of its
points and the smallest vec_id below it.  For a query q a box [lo, hi] bounds
the inner product by sum(max(q * lo, q * hi)); the traversal takes nodes best
bound first and ends once no node can beat the query's kth hit.  A first pass,
over one shard of the region whose mean is best for the query, finds a kth hit;
the second goes to the other shards whose box can beat it, and starts from it.

The queries are a stated set, met with shards in blocks; a shard and one batch
of queries is all that a task holds.  The boxes are bounded: REGIONS of them.

Scores are exact integers: products in doubles where no sum can reach 2**53, in
64-bit integers where none can reach 2**63, else in Python's.

Defined results: vectors that are null or hold a null or non-finite component
take no part, nor do rows with a null vec_id; vectors shorter than the longest
count as zero there; ties go to the smaller vec_id; repeated vectors each take
a rank; rows that share a vec_id are rows of their own: each is a query with
its own ranking and a candidate of all the others; fewer candidates than k give
them all; components or scores beyond a 64-bit integer are an error; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basewise.llm.common import written

K, LEAF, SCALE = 20, 1024, 64
#: Vectors a shard holds, about, and queries that go through a tree at once.
SHARD, BATCH = 32_768, 512
#: Vectors the regions are learnt from, and regions at most.
SAMPLE, REGIONS = 16_384, 1024
#: Integers below this are exact as doubles.
EXACT = 2.0**53


def products(q: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two integer matrices."""
    if not q.size or not points.size:
        return np.zeros((len(q), len(points)), np.int64)
    most = np.abs(q.astype(np.float64)).sum(1).max() * np.abs(points.astype(np.float64)).max()
    if most < EXACT:
        return q.astype(np.float64) @ points.T.astype(np.float64)
    if most < 2.0**62:
        return q @ points.T
    exact = q.astype(object) @ points.T.astype(object)
    if max(abs(int(x)) for x in exact.ravel()) >= 1 << 63:
        raise ValueError("an inner product is beyond a 64-bit integer")
    return exact.astype(np.int64)


def bounds(q: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The greatest inner product of each query with any point of each box."""
    q, lo, hi = q.astype(np.float64), lo.astype(np.float64), hi.astype(np.float64)
    got = np.maximum(q, 0) @ hi.T + np.minimum(q, 0) @ lo.T
    most = np.abs(q) @ np.maximum(np.abs(lo), np.abs(hi)).T
    # Beyond the exact range the bound is raised over its rounding.
    return got + np.where(most < EXACT, 0, most * 1e-12)


class KDTree:
    """Boxes over integer points, in arrays."""

    def __init__(self, points: np.ndarray, ids: np.ndarray, rows: np.ndarray, leaf: int = LEAF):
        lo, hi, first, kids, spans, place, placed = [], [], [], [], [], [], 0
        todo = [(np.lexsort((rows, ids)), -1, 0)]
        while todo:
            held, parent, side = todo.pop()
            node = len(lo)
            if parent >= 0:
                kids[parent][side] = node
            box = points[held]
            lo.append(box.min(0))
            hi.append(box.max(0))
            first.append(ids[held[0]])
            kids.append([-1, -1])
            spans.append((placed, placed))
            if len(held) <= leaf:
                place.append(held)
                spans[node] = (placed, placed + len(held))
                placed += len(held)
                continue
            axis = int((hi[node].astype(np.float64) - lo[node]).argmax())
            # A stable order: equal points are split by vec_id.
            cut = np.argsort(box[:, axis], kind="stable")
            half = len(held) // 2
            todo += [(held[np.sort(cut[half:])], node, 1), (held[np.sort(cut[:half])], node, 0)]
        order = np.concatenate(place)
        self.lo, self.hi, self.kids, self.spans, self.first = np.array(lo), np.array(hi), np.array(kids), np.array(spans), np.array(first)
        self.points, self.ids, self.rows = points[order], ids[order], rows[order]
        self.sizes = np.abs(self.points.astype(np.float64))

    def search(self, q: np.ndarray, own: np.ndarray, floor: np.ndarray, floor_id: np.ndarray, k: int = K) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The k best of each row of q: (place in q, vec_id, score), in no order.

        own: the query's row, never its hit.  floor, floor_id: a kth hit found
        elsewhere, which hits have to beat (-inf: none).
        """
        m = len(q)
        bound = bounds(q, self.lo, self.hi)
        kth, kth_id = floor.astype(np.float64).copy(), floor_id.copy()
        at, ids, scores = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        front = np.full(bound.shape, -np.inf)
        front[:, 0] = bound[:, 0]
        live = np.arange(m)
        while len(live):
            node = front[live].argmax(1)
            top = front[live, node]
            live, node, top = live[top > -np.inf], node[top > -np.inf], top[top > -np.inf]
            front[live, node] = -np.inf
            # Bounds only fall from here on; at the kth score only a smaller id counts.
            over = top >= kth[live]
            live, node, top = live[over], node[over], top[over]
            going = (top > kth[live]) | (self.first[node] < kth_id[live])
            inner = going & (self.kids[node, 0] >= 0)
            for side in (0, 1):
                kid = self.kids[node[inner], side]
                front[live[inner], kid] = bound[live[inner], kid]
            leaf = going & ~inner
            order = np.argsort(node[leaf], kind="stable")
            who, leaves = live[leaf][order], node[leaf][order]
            edges = np.r_[0, np.flatnonzero(np.diff(leaves)) + 1, len(leaves)] if len(leaves) else []
            new = [(at, ids, scores)]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                s, e = self.spans[leaves[a]]
                new.append(self._leaf(q[who[a:b]], who[a:b], own[who[a:b]], kth[who[a:b]], s, e, k))
            if len(new) > 1:
                at, ids, scores = (np.concatenate(x) for x in zip(*new, strict=True))
                order = np.lexsort((ids, -scores, at))
                at, ids, scores = at[order], ids[order], scores[order]
                rank = np.arange(len(at)) - np.searchsorted(at, at)
                at, ids, scores, rank = at[rank < k], ids[rank < k], scores[rank < k], rank[rank < k]
                full = rank == k - 1
                better = scores[full] >= kth[at[full]]
                kth[at[full][better]], kth_id[at[full][better]] = scores[full][better], ids[full][better]
        return at, ids, scores

    def _leaf(self, q: np.ndarray, who: np.ndarray, own: np.ndarray, kth: np.ndarray, s: int, e: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The hits of a leaf that can be among the k best."""
        got = products(q, self.points[s:e])
        mine = self.rows[s:e][None, :] == own[:, None]
        most = got.max(1)
        least = kth.copy()
        new = (most >= kth) & (e - s > k)
        if new.any():  # the kth here, one place on as the query itself may stand there
            least[new] = np.maximum(least[new], np.partition(got[new], e - s - k - 1, axis=1)[:, e - s - k - 1])
        row, col = np.nonzero((got >= least[:, None]) & ~mine)
        return who[row], self.ids[s:e][col], got[row, col].astype(np.int64)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Lists of integers as rows, short ones with zeros at the end."""
    ends = np.asarray(column.offsets)
    size = np.diff(ends)
    out = np.zeros((len(size), dims), np.int64)
    flat = np.asarray(column.values)[ends[0] : ends[-1]]
    out[np.repeat(np.arange(len(size)), size), np.arange(len(flat)) - np.repeat(ends[:-1] - ends[0], size)] = flat
    return out


@dataclass
class Splits:
    """Median splits of space, breadth first: node i's kids are 2i+1 and 2i+2."""

    axis: np.ndarray
    at: np.ndarray
    depth: int

    @classmethod
    def of(cls, sample: np.ndarray, regions: int) -> Splits:
        depth = max(regions - 1, 0).bit_length()
        axis, at = np.zeros(2**depth - 1, np.int64), np.zeros(2**depth - 1, np.int64)
        held = {0: sample}
        for node in range(2**depth - 1):
            x = held.pop(node)
            if len(x):
                axis[node] = (x.max(0).astype(np.float64) - x.min(0)).argmax()
                at[node] = np.sort(x[:, axis[node]])[len(x) // 2]
            left = x[:, axis[node]] < at[node]
            held[2 * node + 1], held[2 * node + 2] = x[left], x[~left]
        return cls(axis, at, depth)

    def region(self, x: np.ndarray) -> np.ndarray:
        node, rows = np.zeros(len(x), np.int64), np.arange(len(x))
        for _ in range(self.depth):
            node = 2 * node + 1 + (x[rows, self.axis[node]] >= self.at[node])
        return node - (2**self.depth - 1)


def _routed(points: DataFrame, splits: Splits, dims: int) -> DataFrame:
    """(vec_id, row, v) -> with region."""

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            region = splits.region(_matrix(batch.column(2), dims)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(region)], ["vec_id", "row", "v", "region"])

    return points.select("vec_id", "row", "v").mapInArrow(route, "vec_id long, row long, v array<long>, region int")


@dataclass
class Regions:
    """Of each region that holds points: its number, box, mean, least id, shards."""

    number: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    mean: np.ndarray
    first: np.ndarray
    shards: np.ndarray

    @classmethod
    def of(cls, routed: DataFrame, dims: int, shard: int) -> Regions:
        """One row a region and task, added up by region on the executors."""
        schema = "region int, n long, first long, lo array<long>, hi array<long>, total array<double>"
        names = [c.split()[0] for c in schema.split(", ")]

        def arrays(rows: list[tuple]) -> pa.RecordBatch:
            types = [pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.float64())]
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

        def add(held: dict[int, tuple], region: int, n: int, first: int, lo: np.ndarray, hi: np.ndarray, total: np.ndarray) -> None:
            if region in held:
                _, m, f, a, b, t = held[region]
                n, first, lo, hi, total = n + m, min(first, f), np.minimum(lo, a), np.maximum(hi, b), total + t
            held[region] = (region, n, first, lo, hi, total)

        def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[int, tuple] = {}
            for batch in batches:
                region, ids, x = batch.column(0).to_numpy(), batch.column(1).to_numpy(), _matrix(batch.column(2), dims)
                for r in np.unique(region):
                    own = region == r
                    add(held, int(r), int(own.sum()), int(ids[own].min()), x[own].min(0), x[own].max(0), x[own].sum(0, dtype=np.float64))
            if held:
                yield arrays(list(held.values()))

        def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[int, tuple] = {}
            for batch in batches:
                for r in batch.to_pylist():
                    add(held, r["region"], r["n"], r["first"], np.array(r["lo"]), np.array(r["hi"]), np.array(r["total"]))
            if held:
                yield arrays(list(held.values()))

        told = routed.select("region", "vec_id", "v").mapInArrow(part, schema).repartition("region").mapInArrow(whole, schema).toArrow().sort_by("region")
        n = told.column("n").to_numpy()
        box = lambda c: np.array(told.column(c).to_pylist()).reshape(len(n), dims)
        return cls(told.column("region").to_numpy().astype(np.int64), box("lo"), box("hi"), box("total") / n[:, None], told.column("first").to_numpy(), -(-n // shard))


def _dealt(df: DataFrame, regions: Regions) -> DataFrame:
    """df with its shard: the region's number, and below it a share of its rows."""
    shards = np.ones(int(regions.number.max()) + 1, np.int64)
    shards[regions.number] = regions.shards
    size = F.get(F.array(*(F.lit(int(x)) for x in shards)), F.col("region"))
    return df.withColumn("shard", F.col("region").cast("long") * (1 << 32) + F.pmod(F.xxhash64("row"), size))


def _asked(queries: DataFrame, regions: Regions, dims: int, home: bool) -> DataFrame:
    """The shards that each query has to see.

    home: only one, of the region whose mean is best, which every query meets
    first.  Else all others whose box can beat the query's floor.
    """
    schema = "shard long, vec_id long, row long, v array<long>, floor long, floor_id long"
    names = [c.split()[0] for c in schema.split(", ")]

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for s in range(0, whole.num_rows, BATCH):
                batch = whole.slice(s, BATCH)
                x, row = _matrix(batch.column(2), dims), batch.column(1).to_numpy()
                best = (x @ regions.mean.T).argmax(1)
                first = regions.number[best] * (1 << 32) + row % regions.shards[best]
                if home:
                    at, shard = np.arange(len(x)), first
                else:
                    floor = np.array([-np.inf if f is None else f for f in batch.column(3).to_pylist()], np.float64)
                    ids = np.array([0 if f is None else f for f in batch.column(4).to_pylist()], np.int64)
                    bound = bounds(x, regions.lo, regions.hi)
                    open_ = (bound > floor[:, None]) | ((bound == floor[:, None]) & (regions.first[None, :] < ids[:, None]))
                    at, region = np.nonzero(open_)
                    many = regions.shards[region]
                    at, region = np.repeat(at, many), np.repeat(region, many)
                    shard = regions.number[region] * (1 << 32) + np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many)
                    other = shard != first[at]
                    at, shard = at[other], shard[other]
                for a in range(0, len(at), 8 * BATCH):
                    part = batch.take(pa.array(at[a : a + 8 * BATCH]))
                    yield pa.RecordBatch.from_arrays([pa.array(shard[a : a + 8 * BATCH].astype(np.int64)), *part.columns], names)

    return queries.select("vec_id", "row", "v", "floor", "floor_id").mapInArrow(ask, schema)


def _pass(points: DataFrame, asked: DataFrame, dims: int, k: int) -> DataFrame:
    """Every query row against the shard it names: (query_row, vec_id, score)."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held, tree = None, [], None
        for batch in batches:
            shards, kind = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            ids, rows, x = batch.column(2).to_numpy(), batch.column(3).to_numpy(), _matrix(batch.column(4), dims)
            edges = np.r_[0, np.flatnonzero((np.diff(shards) != 0) | (np.diff(kind) != 0)) + 1, len(ids)]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if shards[a] != shard:
                    shard, held, tree = shards[a], [], None
                if kind[a] == 0:
                    held.append((x[a:b], ids[a:b], rows[a:b]))
                    continue
                if tree is None and held:
                    tree, held = KDTree(*(np.concatenate(c) for c in zip(*held, strict=True))), []
                if tree is None:
                    continue
                floor = np.array([-np.inf if f is None else f for f in batch.column(5).slice(a, b - a).to_pylist()], np.float64)
                floor_id = np.array([0 if f is None else f for f in batch.column(6).slice(a, b - a).to_pylist()], np.int64)
                for s in range(a, b, BATCH):
                    e = min(b, s + BATCH)
                    at, hit, score = tree.search(x[s:e], rows[s:e], floor[s - a : e - a], floor_id[s - a : e - a], k)
                    yield pa.RecordBatch.from_arrays([pa.array(ids[s:e][at]), pa.array(rows[s:e][at]), pa.array(hit), pa.array(score)], ["query_id", "query_row", "vec_id", "score"])

    none = F.lit(None).cast("long")
    both = points.select("shard", F.lit(0).alias("kind"), "vec_id", "row", "v", none.alias("floor"), none.alias("floor_id"))
    both = both.unionByName(asked.select("shard", F.lit(1).alias("kind"), "vec_id", "row", "v", "floor", "floor_id"))
    return both.repartition("shard").sortWithinPartitions("shard", "kind").mapInArrow(find, "query_id long, query_row long, vec_id long, score long")


def top_k(points: DataFrame, is_query: Column, k: int = K, shard: int = SHARD) -> DataFrame:
    """(vec_id, v) -> the exact k best of each row that is_query names, among
    all other rows: query_id, rank, vec_id, score."""
    # Rows have a number of their own, fixed by writing them.
    points = written(points.select("vec_id", "v", F.monotonically_increasing_id().alias("row")), "vectors")
    n, dims = points.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    # At least a few shards, so that small tables use every core as well.
    wanted = max(1, -(-n // shard), min(points.sparkSession.sparkContext.defaultParallelism, -(-n // 1024)))
    sample = points.orderBy(F.xxhash64("row"), "row").limit(SAMPLE).select("v").toArrow().column("v").combine_chunks()
    splits = Splits.of(_matrix(sample, dims or 0), min(wanted, REGIONS))
    points = _routed(points, splits, dims or 0)
    regions = Regions.of(points, dims or 0, shard)
    none = F.lit(None).cast("long")
    queries = points.where(is_query).withColumns({"floor": none, "floor_id": none})
    points = _dealt(points, regions) if n else points.withColumn("shard", F.lit(0).cast("long"))
    order = [F.desc("score"), F.asc("vec_id")]
    w = Window.partitionBy("query_row").orderBy(*order)
    # Pass one's hits are one shard's k best of each query, and so bounded.
    first = written(_pass(points, _asked(queries, regions, dims, True), dims, k), "hits")
    last = first.withColumn("rank", F.row_number().over(w)).where(F.col("rank") == k).select(F.col("query_row"), F.col("score").alias("floor"), F.col("vec_id").alias("floor_id"))
    again = queries.drop("floor", "floor_id").join(last, F.col("row") == F.col("query_row"), "left")
    hits = first.unionByName(_pass(points, _asked(again, regions, dims, False), dims, k))
    ranked = hits.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def quantised(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, embedding) -> (vec_id, v): floor(scale * x) of the whole vectors."""
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    held = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    held = held.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & whole)
    beyond = F.raise_error(F.lit("a component is beyond a 64-bit integer")).cast("long")
    return held.select("vec_id", F.transform("embedding", lambda x: F.when(F.abs(x * F.lit(scale)) < 2.0**63, F.floor(x * F.lit(scale))).otherwise(beyond)).alias("v"))


def op2_kdtree(embeddings: DataFrame) -> DataFrame:
    """query_id, rank, vec_id, score for every vec_id divisible by 20."""
    return top_k(quantised(embeddings), F.col("vec_id") % 20 == 0)
