"""The training-data operators against brute force, round trips and labels."""

import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from basewise.llm import decontamination, html_extraction, kdtree_search, language_id, line_dedup, packing, quality, simhash_dedup, simhash_similar, token_counts, toxicity
from basewise.llm.common import components
from basewise.llm.html_blocks import blocks

DOC = "doc_id long, text string, lang string, source string, n_chars long, score double, w string"
WORDS = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim minim veniam quis nostrud".split()


def documents(spark, texts, langs=None):
    """Documents with extra columns whose names the operators use themselves."""
    rows = [(i, t, (langs or {}).get(i), "s", len(t or ""), 0.5, "x") for i, t in texts]
    return spark.createDataFrame(rows, DOC)


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", ".", ","]) for _ in range(n))


# --- 7


def plain_fingerprint(text):
    import xxhash

    held = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not held:
        return 0
    told = [" ".join(held[i : i + 4]) for i in range(max(1, len(held) - 3))]
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in told]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(items):
    """items: (id, fingerprint); the smallest id reachable by 4 bits or fewer."""
    root = {i: i for i, _ in items}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in items:
        for j, b in items:
            if (a ^ b).bit_count() <= 4 and find(i) != find(j):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: find(i) for i, _ in items}


def test_simhash_components(spark):
    rng = random.Random(4)
    texts = []
    for _ in range(12):
        base = prose(rng, 150).split()
        for _ in range(4):
            copy = list(base)
            copy[rng.randrange(len(copy))] = "changed"
            texts.append(" ".join(copy))
    texts += [None, "", "  \t ", "Two words", "two WORDS", " x y z", texts[0], texts[0]]
    docs = documents(spark, list(enumerate(texts)))
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash_dedup.op7_simhash(docs).collect()}
    prints = [(i, plain_fingerprint(t)) for i, t in enumerate(texts)]
    want = plain_components(prints)
    assert got == {i: (f"{f:016x}", want[i]) for i, f in prints}


def shingle_sets(texts, size=5):
    held = [(t or "").lower().split() for t in texts]
    return [{tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set() for w in held]


def plain_groups(texts, similarity=0.8):
    """Groups of texts, by all pairs, as sets of places."""
    sets, root = shingle_sets(texts), list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a == b == set() or (min(len(a), len(b)) >= similarity * max(len(a), len(b)) and len(a & b) >= similarity * len(a | b) and a | b):
                root[find(i)] = find(j)
    out = {}
    for i in range(len(texts)):
        out.setdefault(find(i), set()).add(i)
    return {frozenset(x) for x in out.values()}


def near_copies(rng, bases, copies):
    words, texts = [f"w{i}" for i in range(3000)], []
    for _ in range(bases):
        base = [rng.choice(words) for _ in range(rng.randint(20, 300))]
        texts.append(" ".join(base))
        for _ in range(copies):
            w = list(base)
            for _ in range(int(len(w) * rng.uniform(0, 0.03))):
                w[rng.randrange(len(w))] = rng.choice(words)
            texts.append(" ".join(w[: int(len(w) * rng.uniform(0.85, 1))] if rng.random() < 0.3 else w))
    return texts


def test_similar_texts(spark):
    """Groups by five-word similarity against all pairs; a few borderline pairs
    may be missed (RECALL), none is invented."""
    texts = near_copies(random.Random(1), 120, 3) + ["", None, "  ", "Two words", "two  WORDS", "two word"]
    docs = documents(spark, list(enumerate(texts))).repartition(4)
    have = {}
    for r in simhash_similar.similar(docs).collect():
        have.setdefault(r.component, set()).add(r.doc_id)
    got, want = {frozenset(x) for x in have.values()}, plain_groups(texts)
    assert all(any(g <= w for w in want) for g in got)
    assert len(got & want) >= 0.95 * len(want) and frozenset({480, 481, 482}) in got and frozenset({483, 484}) in got
    kept = simhash_similar.one_of_each_group(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {min(x) for x in got}


def test_similar_candidates_at_every_size(spark):
    """The layouts for few and for very many texts find pairs alike."""
    texts = near_copies(random.Random(2), 100, 3)
    prints = simhash_similar.written(simhash_similar._prints(documents(spark, list(enumerate(texts))), 5), "prints")
    node = {r.doc_id: r.node for r in prints.collect()}
    sets, unique = shingle_sets(texts), prints.select("node", "fp").distinct()
    pairs = [(i, j) for i in range(len(texts)) for j in range(i // 4 * 4, i) if node[i] != node[j] and 0.8 <= len(sets[i] & sets[j]) / len(sets[i] | sets[j])]
    for size in (1000, 10**6, 10**9):
        found = {(r.a, r.b) for r in simhash_similar._candidates(unique, *simhash_similar.layout(size)).collect()}
        hit = sum((min(node[i], node[j]), max(node[i], node[j])) in found for i, j in pairs)
        assert hit >= 0.95 * len(pairs) and len(found) < 3 * len(pairs)


def changed(rng, words, at):
    """words with one replaced at each of the places."""
    return [f"new{rng.getrandbits(60)}" if i in at else w for i, w in enumerate(words)]


def test_similar_leaves_no_link_out(spark):
    """Pairs at just the similarity, alone and among dozens of one key whose
    leaders are less similar; those just below it stay apart."""
    rng, texts = random.Random(5), []
    base = lambda: [f"w{rng.randrange(3000)}" for _ in range(139)]
    for n in range(200):
        # 135 shingles, of which 3 words change 15: 120 of 150.  A fourth is too many.
        one = base()
        texts += [one, changed(rng, one, [10, 40, 70] if n % 4 else [10, 40, 70, 100])]
    family = base()
    for i in range(30):
        one = changed(rng, family, [4 + i * 4, (60 + i * 4) % 135, (95 + i * 4) % 135])
        texts += [one, changed(rng, one, [(25 + i * 4) % 130 + 4, (75 + i * 4) % 130 + 4])]
    texts = [" ".join(x) for x in texts]
    have = {}
    for r in simhash_similar.similar(documents(spark, list(enumerate(texts))).repartition(4)).collect():
        have.setdefault(r.component, set()).add(r.doc_id)
    assert {frozenset(x) for x in have.values()} == plain_groups(texts)


def test_only_near_texts_are_read_again(spark, monkeypatch):
    """Texts that share half their shingles meet, but aren't compared in whole;
    no pair of the similarity is left out for that."""
    rng, texts, given = random.Random(7), [], []
    fresh = lambda n: [f"w{rng.getrandbits(50)}" for _ in range(n)]
    for n in range(80):
        one = fresh(60 + 7 * n)
        texts += [one, one[: len(one) * 2 // 3] + fresh(len(one) // 3)]
    for n in range(40):
        one = fresh(139)
        texts += [one, changed(rng, one, [10, 40, 70])]
    texts = [" ".join(x) for x in texts]
    links = simhash_similar._links

    def counted(docs, known, pairs, *rest):
        given.append(pairs.count())
        return links(docs, known, pairs, *rest)

    monkeypatch.setattr(simhash_similar, "_links", counted)
    have = {}
    for r in simhash_similar.similar(documents(spark, list(enumerate(texts))).repartition(3)).collect():
        have.setdefault(r.component, set()).add(r.doc_id)
    assert {frozenset(x) for x in have.values()} == plain_groups(texts)
    assert len(given) == 2 and sum(given) <= 44


def test_signatures_lose_no_pair():
    """The bound holds at every size, also across a power of two."""
    rng = np.random.default_rng(8)
    draw = lambda n: rng.integers(0, 2**64, n, dtype=np.uint64)
    sets, want = [], []
    for n in (0, 1, 2, 5, 9, 60, 64, 65, 130, 515, 1030, 4100):
        for share in (1, 0.95, 0.9, 0.889, 0.85, 0.7, 0.5, 0):
            for other in (n, int(n * 0.95), int(n * 0.8)):
                a = draw(n)
                b = np.r_[a[: int(min(n, other) * share)], draw(other - int(min(n, other) * share))]
                sets.append((np.unique(a), np.unique(b)))
                both = len(np.intersect1d(a, b))
                want.append(both / max(1, n + other - both))
    n, m = (np.array([len(s[i]) for s in sets]) for i in (0, 1))
    x, y = (simhash_similar.pa.array([simhash_similar.signature(s[i]) for s in sets]) for i in (0, 1))
    got, want = simhash_similar.near_enough(n, x, m, y, 0.8), np.array(want)
    assert got[want >= 0.8].all() and (want >= 0.8).sum() > 40
    large = np.minimum(n, m) > 200
    assert not got[large & (want < 0.65)].any() and (large & (want < 0.65)).sum() > 20


def test_texts_that_meet_by_many_or_few():
    """Pairs of a shingle are the same one by one and row by row."""
    rng = np.random.default_rng(6)
    for rows in (2, 40, 64, 65, 200):
        n = np.sort(rng.integers(10, 30, rows)).astype(np.int32)
        parts, nodes, place = rng.integers(0, 4, rows), np.arange(rows), rng.integers(0, 5, rows).astype(np.int32)
        got = {(int(min(x, y)), int(max(x, y))) for a, b in simhash_similar.met(np.zeros(rows, np.int64), nodes, parts, n, place, 0.8) for x, y in zip(a, b, strict=True)}
        want = {(i, j) for j in range(rows) for i in range(j) if parts[i] != parts[j] and 5 * n[i] >= 4 * n[j] and 9 * min(n[i] - place[i], n[j] - place[j]) >= 4 * (n[i] + n[j])}
        assert got == want


def test_one_row_of_each_group_stays(spark):
    """Repeated rows, shared and null doc_ids, other columns of any name."""
    a, b = " ".join(WORDS), " ".join(reversed(WORDS))
    schema = "doc_id long, text string, row string, k long, node map<string, int>"
    rows = [(1, a, "p", 1, {"x": 1}), (1, a, "p", 1, {"x": 1}), (1, b, "q", 2, {}), (2, b.upper(), "r", 3, {}), (None, a, "s", 4, {}), (None, "only here", "t", 5, {}), (None, "only here", "t", 5, {}), (3, None, "u", 6, None), (4, "", "v", 7, None)]
    docs = spark.createDataFrame(rows, schema)
    got = simhash_similar.one_of_each_group(docs)
    assert got.columns == docs.columns
    assert sorted((r.row, r.doc_id, r.k) for r in got.collect()) == [("p", 1, 1), ("q", 1, 2), ("t", None, 5), ("u", 3, 6)]
    assert simhash_similar.one_of_each_group(docs.where("false")).count() == 0


def test_leaders_of_long_keys():
    """A key that comes in blocks is paired like one that comes at once."""
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**63, 6, dtype=np.uint64)
    chains = np.array([base[i % 6] ^ np.uint64(1 << int(rng.integers(0, 63))) for i in range(3000)])
    nodes, keys = np.arange(3000), np.zeros(3000, np.int64)
    for blocks_ in (1, 7):
        led = simhash_similar.Leaders(16, out := [])
        for part in np.array_split(np.arange(3000), blocks_):
            led.take(keys[part], nodes[part], chains[part])
        pairs = [(int(x), int(y)) for a, b in out for x, y in zip(a, b, strict=True)]
        assert len(pairs) == 2994 and all(x % 6 == y % 6 for x, y in pairs)


def test_chains_lose_no_link(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    flips = [x ^ np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, k).astype(np.uint64)) for x in base for k in (1, 2, 3, 4, 5, 7)]
    dense = [base[0] ^ np.uint64(i << 20) for i in range(64)]
    fps = np.unique(np.concatenate([base, np.array(flips, np.uint64), np.array(dense, np.uint64)]))
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    edges = simhash_dedup.links(df)
    assert all(((a ^ b) & (2**64 - 1)).bit_count() <= 4 for a, b in edges.collect())
    roots = {r.node: r.root for r in components(edges).collect()}
    want = plain_components([(int(x), int(x) & (2**64 - 1)) for x in fps.view(np.int64)])
    assert all(roots.get(x, x) == want[x] for x in want)


def test_components(spark):
    chain = [(i, i + 1) for i in range(30)] + [(100, 101), (101, 100), (7, 7), (None, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 31)} | {101: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- 2


def plain_search(rows, k=20):
    """[(vec_id, integers)] -> Counter of (query_id, rank, vec_id, score), by Python's integers."""
    out = Counter()
    for i, (q, x) in enumerate(rows):
        if q % 20 == 0:
            told = sorted((-sum(a * b for a, b in zip(x, y, strict=True)), v) for j, (v, y) in enumerate(rows) if j != i)
            out.update((q, n + 1, v, -s) for n, (s, v) in enumerate(told[:k]))
    return out


def answers(df):
    return Counter((r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect())


@pytest.mark.parametrize("dims,leaf", [(3, 4), (16, 128)])
def test_tree_is_exact(dims, leaf):
    rng = np.random.default_rng(dims)
    x = rng.integers(-6, 6, (700, dims))
    x[200:400] = x[0]
    ids, rows = rng.permutation(5000)[:700], np.arange(700)
    tree = kdtree_search.KDTree(x, ids, rows, leaf)
    none, zero = np.full(30, -np.inf), np.zeros(30, np.int64)
    row, hit, score = tree.search(x[:30], rows[:30], none, zero)
    for i in range(30):
        s = (x @ x[i]).astype(int)
        want = sorted((-v, d) for v, d, r in zip(s, ids, rows, strict=True) if r != i)[:20]
        assert sorted(zip(-score[row == i], hit[row == i], strict=True)) == want
        # From a floor that is some hit's, all hits better than it are found.
        at = np.full(30, -want[9][0]), np.full(30, want[9][1])
        mine, hit2, score2 = tree.search(x[:30], rows[:30], at[0].astype(float), at[1])
        assert set(want[:9]) <= set(zip(-score2[mine == i], hit2[mine == i], strict=True))


def test_search(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(v) for v in rng.standard_normal(6)]) for i in range(90)]
    rows += [(100, None), (120, [1.0, None] + [0.0] * 4), (140, [float("nan")] * 6), (160, [float("inf")] * 6), (None, [1.0] * 6), (200, rows[20][1])]
    v = kdtree_search.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    held = [(r.vec_id, list(r.v)) for r in v.collect()]
    assert sorted(i for i, _ in held) == [*range(90), 200]
    assert answers(kdtree_search.top_k(v, F.col("vec_id") % 20 == 0, k=20, shard=16)) == plain_search(held)
    clash = spark.createDataFrame([(*r, 1, 2, "s") for r in rows], "vec_id long, embedding array<float>, row int, shard int, rank string")
    assert answers(kdtree_search.op2_kdtree(clash)) == plain_search(held)
    assert kdtree_search.op2_kdtree(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_search_of_repeated_rows(spark):
    """Rows that share a vec_id are queries and candidates of their own; a
    vector that fills most of the table is dealt over several shards."""
    rng = np.random.default_rng(9)
    rows = [(int(rng.integers(0, 60)), [int(v) for v in rng.integers(-9, 9, 4)]) for _ in range(80)]
    rows += [(20, rows[0][1]), (20, rows[0][1]), (20, [5, 5, 5, 5])] + [(100 + i, [3, -2, 1, 0]) for i in range(120)]
    v = spark.createDataFrame(rows, "vec_id long, v array<long>")
    assert answers(kdtree_search.top_k(v, F.col("vec_id") % 20 == 0, shard=16)) == plain_search(rows)


@pytest.mark.parametrize("size", [10**4, 10**8, 3 * 10**8])
def test_search_of_large_components(spark, size):
    """Doubles no longer hold the products; 64-bit integers and then Python's do."""
    rng = np.random.default_rng(size)
    rows = [(i, [int(v) for v in rng.integers(-size, size, 8)]) for i in range(300)]
    rows += [(300 + i, [x + (i % 3 == 0) for x in rows[i][1]]) for i in range(60)]
    v = spark.createDataFrame(rows, "vec_id long, v array<long>")
    assert answers(kdtree_search.top_k(v, F.col("vec_id") % 20 == 0, shard=64)) == plain_search(rows)


def test_products_are_exact_or_an_error():
    x = np.array([[3 * 10**9, 1], [2, -(10**9)]])
    assert kdtree_search.products(x[1:], x).tolist() == [[6 * 10**9 - 10**9, 4 + 10**18]]
    with pytest.raises(ValueError):
        kdtree_search.products(x[:1] * 2, x[:1])


# --- 10


def plain_line_dedup(docs):
    """[(doc_id, text)] -> texts, by all pairs of lines."""
    seen, out = [], []

    def one_edit(a, b):
        if abs(len(a) - len(b)) > 1:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) <= 1
        a, b = sorted((a, b), key=len)
        return any(a == b[:i] + b[i + 1 :] for i in range(len(b)))

    for _, text in sorted(docs):
        kept = []
        for line in text.split("\n"):
            w = line.split()
            if not w:
                kept.append(line)
                continue
            if not any(w == v or (min(len(w), len(v)) >= 5 and one_edit(w, v)) for v in seen):
                kept.append(line)
            if w not in seen:
                seen.append(w)
        out.append("\n".join(kept))
    return out


def test_line_dedup(spark):
    rng = random.Random(8)
    bases = [[rng.choice(WORDS) for _ in range(rng.randint(1, 9))] for _ in range(25)]
    texts = []
    for i in range(40):
        lines = []
        for _ in range(rng.randint(0, 6)):
            w = list(rng.choice(bases))
            how = rng.random()
            at = rng.randrange(len(w))
            if how < 0.25:
                w[at] = rng.choice(WORDS)
            elif how < 0.4:
                w.insert(at, rng.choice(WORDS))
            elif how < 0.55 and len(w) > 1:
                del w[at]
            lines.append(rng.choice([" ", " ", "  ", "\t"]).join(w))
        if rng.random() < 0.3:
            lines.insert(0, "")
        texts.append((i, "\n".join(lines)))
    docs = documents(spark, texts)
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs).collect()}
    assert [got[i] for i, _ in texts] == plain_line_dedup(texts)
    assert line_dedup.dedup_lines(docs).columns == docs.columns


def test_line_dedup_sides_need_no_broadcast(spark, monkeypatch):
    texts = [(1, "a b c d e f\nx"), (2, "a b c d e g\nx\ny"), (3, "a b c d e"), (4, "a b c q d e f")]
    want = {1: "a b c d e f\nx", 2: "y", 3: "", 4: ""}
    for rows in (0, 10):
        monkeypatch.setattr(line_dedup, "BROADCAST_ROWS", rows)
        assert {r.doc_id: r.text for r in line_dedup.dedup_lines(documents(spark, texts)).collect()} == want


def test_line_dedup_edges(spark):
    docs = documents(spark, [(1, None), (2, ""), (None, "same"), (3, "same"), (4, " same "), (5, "\n\n"), (3, "same")])
    got = Counter((r.doc_id, r.text) for r in line_dedup.dedup_lines(docs).collect())
    assert got == Counter([(1, None), (2, ""), (None, "same"), (3, "same"), (4, ""), (5, "\n\n"), (3, "same")])
    assert line_dedup.op10_lines(documents(spark, [])).count() == 0


def test_line_dedup_of_rows_that_share_a_doc_id(spark):
    docs = documents(spark, [(1, "a\nb"), (1, "c\na"), (2, "b\nc\nd")])
    got = sorted((r.doc_id, r.text) for r in line_dedup.dedup_lines(docs).collect())
    kept = [x for _, t in got for x in t.split("\n") if x]
    assert sorted(kept) == ["a", "b", "c", "d"] and got[-1] == (2, "d")


def test_line_dedup_leaves_other_columns_alone(spark):
    """Names that the operator uses itself, dots and nested values among them."""
    names = ["doc", "row", "line", "at", "of", "kept", "lost", "flat", "half", "with", "key", "v", "a.b", "__kept", "__doc", "__lost"]
    schema = "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names) + ", deep struct<doc: array<int>>"
    rows = [(i, f"a b c d e f\nx{i // 2}", *(f"{n}{i}" for n in names), ([i],)) for i in range(4)]
    docs = spark.createDataFrame(rows, schema)
    got = line_dedup.dedup_lines(docs)
    assert got.columns == docs.columns
    want = ["a b c d e f\nx0", "", "x1", ""]
    assert sorted(tuple(r) for r in got.collect()) == [(r[0], want[r[0]], *r[2:]) for r in sorted(rows)]


def test_line_dedup_of_long_lines(spark):
    """One line of very many words costs its words, not their square."""
    rng = random.Random(12)
    w = [rng.choice(WORDS) + str(rng.randrange(1000)) for _ in range(60_000)]
    texts = [" ".join(w), " ".join([*w[:100], "other", *w[101:]]), " ".join(w[:50_000] + w[50_001:]), " ".join([*w[:7], "two", *w[7:40_000], "edits", *w[40_000:]]), " ".join(["more", *w])]
    began = time.time()
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(documents(spark, list(enumerate(texts)))).collect()}
    assert got == {0: texts[0], 1: "", 2: "", 3: texts[3], 4: ""} and time.time() - began < 60


# --- 3


def plain_leaks(docs, items):
    """Similarities by every window of an item's size."""
    words = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    grams = lambda w: Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    out = {}
    held = {i: words(t) for i, t in items if len(words(t)) >= 5}
    for d, text in docs:
        w = words(text)
        for i, item in held.items():
            want = grams(item)
            for start in range(-len(item) + 5, len(w) - 4):
                got = grams(w[max(start, 0) : start + len(item)])
                both = sum((got & want).values())
                if both and both / sum((got | want).values()) >= 0.8:
                    out[d, i] = max(out.get((d, i), 0), both / sum((got | want).values()))
    return out


@pytest.mark.parametrize("rows", [0, 1000])
def test_decontamination(spark, rows):
    rng = random.Random(2)
    items = [(i, prose(rng, n)) for i, n in enumerate([8, 20, 40, 60, 60, 4, 0])]
    items += [(9, None)]
    docs = [(i, prose(rng, 80)) for i in range(10)]
    docs += [(20, prose(rng, 9) + " " + items[1][1].upper() + " " + prose(rng, 5)), (21, items[2][1] + " end"), (22, " ".join(items[3][1].split()[:57])), (23, items[3][1].replace(" ", "\n")), (24, " ".join(["word"] * 30)), (25, None), (26, "")]
    cut = items[4][1].split()
    docs.append((27, " ".join(["front", *cut[3:]])))
    got = decontamination.contaminated(documents(spark, docs), spark.createDataFrame(items, "item_id long, text string"), rows)
    told = {(r.doc_id, r.item_id): round(r.similarity, 9) for r in got.collect()}
    assert told == {k: round(v, 9) for k, v in plain_leaks(docs, items).items()}


@pytest.mark.parametrize("rows", [0, 1000])
def test_decontamination_of_reordered_passages(spark, rows):
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefghij", k=8))
    item = [word() for _ in range(50)]
    turned = {n: item[n:] + item[:n] for n in (6, 25, 44)}
    docs = [(n, " ".join([word() for _ in range(30)] + w + [word() for _ in range(30)])) for n, w in turned.items()]
    docs += [(100 + n, " ".join(w)) for n, w in turned.items()]
    docs += [(200 + n, " ".join(w[2:] + [word() for _ in range(30)])) for n, w in turned.items()]
    docs += [(300 + n, " ".join([word() for _ in range(30)] + w[:-2])) for n, w in turned.items()]
    docs += [(400, " ".join(item[:25] + [word() for _ in range(30)] + item[25:])), (401, " ".join(word() for _ in range(90)))]
    items = [(1, " ".join(item)), (2, " ".join(word() for _ in range(50)))]
    got = decontamination.contaminated(documents(spark, docs), spark.createDataFrame(items, "item_id long, text string"), rows)
    told = {(r.doc_id, r.item_id): round(r.similarity, 9) for r in got.collect()}
    assert told == {k: round(v, 9) for k, v in plain_leaks(docs, items).items()}
    assert {(25, 1), (125, 1)} <= set(told)


@pytest.mark.parametrize("rows", [0, 1000])
def test_decontamination_recall_near_the_threshold(spark, rows):
    """Passages with words replaced, deleted, added and repeated, against all
    windows: no pair of 0.8 or more is missed."""
    rng = random.Random(17)
    items = [(i, prose(rng, rng.randint(30, 70)) + " " + " ".join("abcdefgh"[i % 8] * 3 for _ in range(i % 3))) for i in range(12)]
    docs = []
    for n in range(400):
        w = items[n % 12][1].split()
        for _ in range(n % 3 + 1):
            at = rng.randrange(len(w))
            rng.choice([lambda: w.__setitem__(at, "other"), lambda: w.pop(at), lambda: w.insert(at, "more"), lambda: w.insert(at, w[at])])()
        docs.append((n, prose(rng, rng.randint(0, 30)) + " " + " ".join(w) + " " + prose(rng, rng.randint(0, 30))))
    want = plain_leaks(docs, items)
    got = decontamination.contaminated(documents(spark, docs), spark.createDataFrame(items, "item_id long, text string"), rows)
    assert {(r.doc_id, r.item_id): round(r.similarity, 9) for r in got.collect()} == {k: round(v, 9) for k, v in want.items()}
    assert sum(0.8 <= v < 0.9 for v in want.values()) >= 20


def test_decontamination_of_repeated_words(spark):
    items = spark.createDataFrame([(1, "word " * 200), (2, "a b " * 100)], "item_id long, text string")
    docs = documents(spark, [(1, "word " * 400), (2, "word " * 5000), (3, "b a " * 3000), (4, "word a b " * 200)])
    decontamination.contaminated(docs, items).collect()
    began = time.time()
    got = {(r.doc_id, r.item_id): r.similarity for r in decontamination.contaminated(docs, items).collect()}
    assert got == {(1, 1): 1.0, (2, 1): 1.0, (3, 2): 1.0} and time.time() - began < 20


def test_decontamination_judges_each_row(spark):
    """Rows that share a doc_id with a leaking one stay; a null doc_id is judged."""
    rng = random.Random(3)
    leak = prose(rng, 30)
    rows = [(1, leak), (1, prose(rng, 50)), (None, "x " + leak), (None, prose(rng, 40)), (2, None), (3, "")]
    docs, items = documents(spark, rows), spark.createDataFrame([(1, leak), (None, leak), (2, None), (4, prose(rng, 20)), (4, leak[9:])], "item_id long, text string")
    kept = Counter((r.doc_id, r.text) for r in decontamination.without_benchmark(docs, items).collect())
    assert kept == Counter(r for r in rows if leak not in (r[1] or ""))
    assert {(r.doc_id, r.item_id) for r in decontamination.contaminated(docs, items).collect()} == {(a, b) for a in (1, None) for b in (1, 4, None)}
    assert decontamination.contaminated(documents(spark, []), items).count() == 0


def test_decontamination_of_nothing(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = documents(spark, [(1, "a b c d e f g")])
    assert decontamination.contaminated(docs, none).count() == 0
    assert decontamination.without_benchmark(docs, none).count() == 1


def test_multi_index_finds_all_within_the_radius():
    rng = random.Random(1)
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), decontamination.RADIUS):
            b ^= 1 << bit
        assert any(((a >> i * 8 ^ b >> i * 8) & 255).bit_count() <= 2 for i in range(8))


# --- 5 and 6


def tokenizer():
    public = pytest.importorskip("public_tokenizers")
    return public.path("byte_bpe_50k.json"), public.PATTERN


ODD = ["", "a", "Hello  world\n\n\tTabs", "naïve Ünïcode ßß", "日本語テキスト", "😀 emoji 👩‍👩‍👧", "<|endoftext|> in text", "x" * 5000, "123 4567 'tis don't", "   　 ", "\x00\x01"]


def test_encoder_equals_the_tokenizers_library():
    from tokenizers import Tokenizer

    path, pattern = tokenizer()
    plain, encode = Tokenizer.from_file(path), packing.encoder(path, pattern)
    for text in [*ODD, " " * 2_000_000 + "a", "\n" * 1_000_000, "ab\u3000\t" * 300_000 + "\t" * 900_000]:
        assert encode(text).tolist() == plain.encode(text, add_special_tokens=False).ids


def test_packing_round_trip(spark):
    from tokenizers import Tokenizer

    path, _ = tokenizer()
    plain, rng = Tokenizer.from_file(path), random.Random(6)
    texts = [*ODD, None, *(prose(rng, rng.choice([1, 30, 300, 3000])) for _ in range(60))]
    docs = documents(spark, list(enumerate(texts))).repartition(3)
    rows = packing.op5_pack(docs).collect()
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for i, text in enumerate(texts):
        ids = [*plain.encode(text or "", add_special_tokens=False).ids, 0]
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for held in by_sequence.values():
        at = 0
        for r in sorted(held, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == 1024 or at & (at - 1) == 0
    assert packing.op5_pack(documents(spark, [])).count() == 0


def test_packing_of_a_very_long_run(spark):
    texts = {1: " " * 2_000_000 + "a", 2: "short"}
    told = packing.op5_pack(documents(spark, list(texts.items()))).collect()
    assert {r.doc_id: r.doc_tokens for r in told} == {i: sum(r.length for r in told if r.doc_id == i) for i in texts}


@pytest.mark.parametrize("shut", ["tokens", "segments", "loss"])
def test_packing_closes_a_sequence_by_each_limit(spark, shut):
    """The same conversations under limits of which one binds."""
    path, pattern = tokenizer()
    rows = [(c, t, ("user", "assistant")[t % 2], " ".join(WORDS[: 3 + (c * 7 + t) % 9])) for c in range(60) for t in range(1 + c % 5)]
    turns = spark.createDataFrame([*rows, (70, None, None, None), (None, 0, "user", "lost")], "conv_id long, turn long, role string, text string").coalesce(1)
    limits = {"tokens": packing.Limits(64, 50, 64), "segments": packing.Limits(512, 3, 512), "loss": packing.Limits(512, 50, 24)}[shut]
    got = packing.pack(packing.conversations(turns).coalesce(1), limits, path, pattern).collect()
    held = {}
    for r in got:
        assert r.length == len(r.ids) == len(r.loss)
        held.setdefault(r.sequence_id, []).append(r)
    full = 0
    for of in held.values():
        use = {"tokens": sum(r.length for r in of), "segments": len(of), "loss": sum(sum(r.loss) for r in of)}
        most = {"tokens": limits.tokens, "segments": limits.segments, "loss": limits.loss}
        assert all(use[k] <= most[k] for k in use)
        full += use[shut] == most[shut] and all(use[k] < most[k] for k in use if k != shut)
    assert full >= len(held) / 3
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(path)
    for c in {r[0] for r in rows}:
        parts = [x for _, _, role, text in sorted(r for r in rows if r[0] == c) for x in ((f"{role}: ", False), (f"{text}\n", role == "assistant"))]
        want = [(i, loss) for text, loss in parts for i in plain.encode(text, add_special_tokens=False).ids] + [(0, False)]
        own = sorted((r for r in got if r.key == c), key=lambda r: r.start)
        assert [x for r in own for x in zip(r.ids, r.loss, strict=True)] == want


def test_packing_of_many_empty_texts(spark):
    docs = documents(spark, [(i, "" if i % 4 else " ".join(WORDS * 30)) for i in range(2000)])
    rows, held = packing.op5_pack(docs).collect(), Counter()
    for r in rows:
        held[r.sequence_id] += 1
    assert sum(r.length for r in rows if r.doc_id % 4) == 1500 and max(held.values()) <= packing.SEGMENTS


def test_packing_keeps_every_limit():
    rng, limits = random.Random(3), packing.Limits(tokens=100, segments=4, loss=30)
    packer, pieces, want = packing.Packer(limits, pool=8), [], {}
    for k in range(80):
        ids = np.array([rng.randrange(9) for _ in range(rng.randint(1, 180))])
        loss = np.array([int(rng.random() < 0.4) for _ in ids])
        want[k] = (ids, loss)
        pieces += packer.add(packing.Example(k, ids, loss))
    pieces += packer.finish()
    for k, (ids, _) in want.items():
        own = sorted((p for p in pieces if p.key == k), key=lambda p: p.start)
        assert np.concatenate([p.ids for p in own]).tolist() == ids.tolist()
    for s in {p.sequence for p in pieces}:
        own = [p for p in pieces if p.sequence == s]
        assert len(own) <= 4 and sum(len(p.ids) for p in own) <= 100
        assert sum(int(want[p.key][1][p.start : p.start + len(p.ids)].sum()) for p in own) <= 30


def greedy(word, pieces):
    n = at = 0
    while at < len(word):
        end = max((e for e in range(at + 1, len(word) + 1) if word[at:e] in pieces), default=None)
        if end is None:
            return -1
        n, at = n + 1, end
    return n


def test_automaton_counts_like_greedy_matching():
    rng = random.Random(9)
    for _ in range(60):
        pieces = {bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(1, 14))}
        automaton = token_counts.Automaton(sorted(pieces))
        for _ in range(60):
            word = bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 14)))
            assert automaton.count(word) == greedy(word, pieces)


def test_token_counts(spark):
    path, _ = tokenizer()
    pieces = set(token_counts.byte_pieces(path))
    texts = [*ODD[:-4], None, "  ", "unbelievable tokenisation"]
    got = {r.doc_id: (r.n_words, r.n_tokens) for r in token_counts.op6_count(documents(spark, list(enumerate(texts)))).collect()}
    for i, t in enumerate(texts):
        words = (t or "").encode().split()
        assert got[i] == (len(words), sum(greedy(b" " + w, pieces) for w in words))


# --- 4, 8 and 9

TONGUES = {"xx": "kro bra dun gha mor".split(), "yy": "lia sei ona tue iva".split()}


def tongue(rng, lang, n):
    return " ".join("".join(rng.choice(TONGUES[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))


def test_language(spark):
    rng = random.Random(1)
    langs = {i: rng.choice(["xx", "yy"]) for i in range(160)}
    texts = [(i, tongue(rng, langs[i], rng.choice([4, 40, 400]))) for i in langs]
    extra = [(500, None), (501, ""), (502, "123 !!"), (503, "½ ²"), (504, "Ⅷ ① ٣ _"), (None, "kro bra")]
    got = {r.doc_id: r for r in language_id.op4_language(documents(spark, texts + extra, langs)).collect()}
    held = [i for i in langs if zlib.crc32(str(i).encode()) % 5 == 0]
    assert {i for i in langs if got[i].held_out} == set(held)
    assert sum(got[i].lang_pred == langs[i] for i in held) >= 0.95 * len(held)
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in range(500, 505))
    assert all(0 <= r.score <= 1 for r in got.values())
    assert language_id.op4_language(documents(spark, [])).count() == 0


def test_language_learns_from_the_whole_text(spark):
    """What tells the languages apart stands behind the first thousands of words."""
    rng = random.Random(5)
    langs = {i: rng.choice(["xx", "yy"]) for i in range(60)}
    texts = [(i, " ".join([tongue(rng, "xx", 300)] + [tongue(rng, langs[i], 900)])) for i in langs]
    got = {r.doc_id: r.lang_pred for r in language_id.op4_language(documents(spark, [*texts, (900, tongue(rng, "yy", 80))], langs)).collect()}
    assert got[900] == "yy" and sum(got[i] == langs[i] for i in langs) >= 57


def test_network_gradients():
    rng = np.random.default_rng(0)
    model = language_id.ByteCNN.new(["a", "b", "c"])
    for a in model.parameters():
        a += rng.standard_normal(a.shape).astype(np.float32) * 0.01
    x, y = rng.integers(0, 256, (6, 32)).astype(np.uint8), np.array([0, 1, 2, 0, 1, 2])

    def loss():
        return -model.log_probabilities(x, model.filters())[np.arange(6), y].mean()

    for a, g in zip(model.parameters(), model.gradients(x, y), strict=True):
        at = np.unravel_index(int(np.abs(g).argmax()), g.shape)
        was, step = a[at], 1e-2
        a[at] = was + step
        up = loss()
        a[at] = was - step
        down = loss()
        a[at] = was
        assert abs((up - down) / (2 * step) - g[at]) < 0.05 * abs(g[at]) + 2e-3


def test_toxicity(spark):
    rng = random.Random(2)
    toxic = {i: int(rng.random() < 0.25) for i in range(600)}
    texts = []
    for i, t in toxic.items():
        w = prose(rng, rng.randint(20, 200)).split()
        for _ in range(3 * t):
            w.insert(rng.randrange(len(w)), rng.choice(["vile", "scum", "rotter"]))
        texts.append((i, " ".join(w)))
    labels = spark.createDataFrame([(i, 1, t) for i, t in toxic.items() if i % 5] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    docs = documents(spark, [*texts, (900, None), (901, "")])
    got = {r.doc_id: r for r in toxicity.op8_toxicity(docs, labels).collect()}
    held = [i for i in toxic if zlib.crc32(str(i).encode()) % 3 == 1]
    assert sum(got[i].predicted == toxic[i] for i in held) >= 0.95 * len(held)
    assert got[900].predicted == got[901].predicted == 0 and all((r.score >= 0.7) == r.predicted for r in got.values())
    kept = {r.doc_id for r in toxicity.without_toxic(docs, labels).collect()}
    assert kept == {i for i, r in got.items() if not r.predicted}
    none = labels.where("false")
    assert {r.score for r in toxicity.op8_toxicity(docs, none).collect()} == {0.0}


def test_rows_are_judged_by_their_own_text(spark):
    rng = random.Random(6)
    texts = [(i, prose(rng, 60) + " vile scum rotter" * (i % 4 == 0)) for i in range(400)]
    texts += [(0, prose(rng, 50)), (None, prose(rng, 50)), (None, prose(rng, 50) + " vile scum rotter")]
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(400)], "doc_id long, quality int, toxic int")
    kept = Counter(r.text for r in toxicity.without_toxic(documents(spark, texts), labels).collect())
    assert kept == Counter(t for _, t in texts if "vile" not in t)


@pytest.mark.parametrize("negative", [False, True])
def test_risk_gradient(negative):
    """Of the non-negative risk, against finite differences in the logits."""
    rng = np.random.default_rng(2)
    z = rng.standard_normal(30)
    z[:12], z[12:] = z[:12] + 2 * negative, z[12:] - 3 * negative

    def worth():
        toxic, rest = toxicity.risk(z, 12, 0.4)
        assert (rest < 0) == negative
        return toxic + max(0, rest)

    got = toxicity.slopes(z, 12, 0.4)
    for i in range(len(z)):
        was = z[i]
        z[i] = was + 1e-6
        up = worth()
        z[i] = was - 1e-6
        down = worth()
        z[i] = was
        assert abs((up - down) / 2e-6 - got[i]) < 1e-8


def test_risk_by_hand():
    """Against the sums of the definition, one text at a time."""
    z, prior = np.array([0.3, -1.2, 0.8, 2.0, -0.5]), 0.25
    loss = lambda x: 1 / (1 + np.exp(x))
    toxic = prior * (loss(0.3) + loss(-1.2)) / 2
    rest = (loss(-0.8) + loss(-2.0) + loss(0.5)) / 3 - prior * (loss(-0.3) + loss(1.2)) / 2
    assert np.allclose(toxicity.risk(z, 2, prior), (toxic, rest))


def test_copies_in_the_sample_teach_no_more_than_one(spark):
    """Copies of a few toxic texts must not make their harmless words toxic, and
    a prior a little over the sample's share must not undo what is learnt."""
    rng = random.Random(7)
    words = ["".join(rng.choices("abcdefghij", k=7)) for _ in range(400)]
    told = lambda bad: " ".join([rng.choice(words) for _ in range(60)] + [rng.choice(["vile", "scum", "rotter"]) for _ in range(3 * bad)])
    texts = [(i, told(i % 9 == 0)) for i in range(1500)]
    texts += [(2000 + i, texts[9 * (i % 3)][1]) for i in range(300)]
    toxic = {i: int("vile" in t or "scum" in t or "rotter" in t) for i, t in texts}
    labels = spark.createDataFrame([(i, 1, x) for i, x in toxic.items()], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.op8_toxicity(documents(spark, texts), labels).collect()}
    held = [i for i in toxic if got[i].held_out and i < 1500]
    assert sum(got[i].predicted == toxic[i] for i in held) >= 0.97 * len(held)


@pytest.mark.parametrize("n", [1, 2, 3])
def test_few_toxic_labels_empty_no_corpus(spark, n):
    rng = random.Random(4)
    open_ = [i for i in range(60) if zlib.crc32(str(i).encode()) % 3 != 1]
    docs = documents(spark, [(i, prose(rng, 40) + (" vile scum" if i in open_[:n] else "")) for i in range(60)])
    labels = spark.createDataFrame([(i, 1, int(i in open_[:n])) for i in open_], "doc_id long, quality int, toxic int")
    assert {r.predicted for r in toxicity.op8_toxicity(docs, labels).collect()} == {0}
    assert toxicity.without_toxic(docs, labels).count() == 60


def test_quality(spark):
    rng = random.Random(3)
    good = {i: int(rng.random() < 0.7) for i in range(400)}
    bad = [lambda w: " | ".join(w), lambda w: "!! ".join(w).upper(), lambda w: " ".join([w[0]] * len(w)), lambda w: "$$$ ".join(w)]
    texts = [(i, prose(rng, 80) if g else rng.choice(bad)(prose(rng, 60).split())) for i, g in good.items()]
    labels = spark.createDataFrame([(i, g, 0) for i, g in good.items()] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality.op9_quality(documents(spark, [*texts, (900, None), (901, "")]), labels).collect()}
    held = [i for i in good if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum(got[i].predicted == good[i] for i in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and (r.score >= 0.3) == r.predicted for r in got.values()) and 900 in got and 901 in got


def test_attention_gradients():
    rng = np.random.default_rng(4)
    model = quality.AttentionMIL.new()
    x, ends, y = rng.random((9, quality.WIDTH)), np.array([2, 3, 9]), np.array([1.0, 0.0, 1.0])
    weight = np.array([1.0, 2.0, 0.5])

    def loss():
        z = model.forward(x, ends)[0]
        return (weight * (np.logaddexp(0, z) - y * z)).mean()

    for a, g in zip(model.held, model.gradients(x, ends, y, weight), strict=True):
        at = np.unravel_index(int(np.abs(g).argmax()), g.shape)
        was = a[at]
        a[at] = was + 1e-5
        up = loss()
        a[at] = was - 1e-5
        down = loss()
        a[at] = was
        assert abs((up - down) / 2e-5 - g[at]) < 1e-5 + 1e-3 * abs(g[at])


# --- 1


@pytest.fixture(scope="module")
def crf():
    return html_extraction.trained()


PAGE = """<!DOCTYPE html><html><head><title>No title</title><style>p{}</style><script>var a="</p><p>no";</script></head><body>
<header class="site-header"><a href="/">Home</a></header><nav><ul><li><a href="/a">Menu one</a><li><a href="/b">Menu two</a></ul></nav>
<div class="cookie-banner">We use cookies. <button>Accept</button></div>
<article><h1>A title &amp; more</h1><p>First  paragraph of the\n story, with <b>bold</b>face and a <a href="x">link</a>.<p>Second &lt;one&gt; &eacute;&#233; here.
<div class="ad">Buy now!</div><p>Short.</p><ul><li>item one is in the article<li>item two is too</ul></article>
<aside class="sidebar"><h3>Related</h3><a href="/c">Other story</a></aside>
<section id="comments"><p>I liked this, says a reader.</p></section><form><label>Your mail</label><input></form>
<footer>&copy; 2024 All rights reserved.</footer><!-- ad --></body></html>"""


def test_extraction(spark, crf):
    want = "A title & more First paragraph of the story, with boldface and a link. Second <one> éé here. Short. item one is in the article item two is too"
    assert html_extraction.extract(crf, [PAGE, None, "", "<p", "<nav><a href=x>only menu</a></nav>"])[:4] == [want, "", "", ""]
    rows = [(1, "u", PAGE, "x"), (2, None, None, "y"), (None, "v", "", "z"), (1, "u", PAGE, "x")]
    got = sorted((str(r.page_id), r.url or "", r.text, r.n_chars) for r in html_extraction.op1_extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect())
    assert got == [("1", "u", want, len(want))] * 2 + [("2", "", "", 0), ("None", "v", "", 0)]


def test_extraction_on_held_out_pages(crf):
    pages, labels = html_extraction.training_pages(120, 777_000)
    wrong = sum((a != b).sum() for a, b in zip(crf.viterbi(pages), labels, strict=True))
    assert wrong <= 0.02 * sum(map(len, labels))


def test_viterbi_is_the_best_chain(crf):
    from itertools import product

    rng = random.Random(2)
    page = [tuple(rng.randrange(1 << html_extraction.BITS) for _ in range(4)) for _ in range(7)]
    emit, *_ = crf.scores([page])

    def worth(y):
        return crf.start[y[0]] + sum(emit[0, t, k] for t, k in enumerate(y)) + sum(crf.step[a, b] for a, b in zip(y, y[1:], strict=False))

    assert tuple(crf.viterbi([page])[0]) == max(product((0, 1), repeat=7), key=worth)


def test_blocks_survive_broken_markup():
    assert [b.text for b in blocks("<p>a<p>b<b>c<div>d</p>e</i><br>f<script>x</script")] == ["a", "bc", "d", "e f"]
    assert [b.text for b in blocks("<td>a<td>b<!-- c <p> --><style>d</style>&nbsp;e")] == ["a", "b e"]


def test_blocks_after_a_head_left_open():
    told = lambda page: [b.text for b in blocks(page)]
    assert told("<html><head><title>T</title><meta name=a><h1>A</h1><p>b") == ["A", "b"]
    assert told("<head><title>T</title> <script>x</script>plain text<p>b") == ["plain text", "b"]
    assert told("<head><noscript><link href=x></noscript><template><p>no</p></template><title>T</title></head><p>b") == ["b"]
    assert told("<head><noscript><img src=x></noscript><title>T</title></head><body><p>b") == ["b"]


HOSTILE = {
    "unclosed quotes": lambda n: '<a "' * n,
    "unclosed values": lambda n: '<a b="' * n,
    "mixed quotes": lambda n: "<a b=\"<i c='" * n,
    "unclosed values, then an end": lambda n: "<p a='x\">" * n,
    "deep blocks": lambda n: "<div>a" * n,
    "deep inline": lambda n: "<b>a<p>" * n,
    "deep unknown": lambda n: "".join(f"<x{i}>a" for i in range(n)),
    "deep names": lambda n: "".join(f"<div class='nav c{i}'>a" for i in range(n)),
    "ends of nothing": lambda n: "<i><b>" * n + "</u></p></i>a" * n,
    "list items": lambda n: "<ul><li>a<b>" * n + "<li>b" * n,
    "open comments": lambda n: "<!-- a " * n,
    "open declarations": lambda n: "<! a " * n,
    "only signs": lambda n: "< <" * n,
    "open scripts": lambda n: "<script>a</scrip>" * n,
    "white space": lambda n: "<a " + "= " * n + ">" + "<p>" + " " * n,
    "attributes": lambda n: "<a " + "class class= " * n + ">x",
    "references": lambda n: "&" * n + "&#" * n + "&amp" * n,
}


@pytest.mark.parametrize("how", HOSTILE)
def test_pages_of_a_megabyte_take_seconds(crf, how):
    n = 1_000_000 // len(HOSTILE[how](1))
    began = time.time()
    html_extraction.extract(crf, [HOSTILE[how](n)])
    assert time.time() - began < 20


def test_blocks_of_unfinished_markup():
    told = lambda page: [b.text for b in blocks(page)]
    assert told("<p title='a > b'>x<p data-x=\"1>2\">y") == ["x", "y"]
    assert told("<p a='never closed>x</p><p>y</p>") == ["x", "y"]
    assert told("<p>3 < 4 and a<b>c</b> <3") == ["3 < 4 and ac <3"]
    assert told("<p>x<p class=") == ["x"]
    assert told("<p>a<select><option>b<p>c</p>") == ["a", "c"]
    assert told("<p>a<iframe><p>b</iframe>c<!-->d<!--->e") == ["a", "cde"]


#: Pages written by hand, with their main text.
HAND_MADE = [
    (
        """<html><head><title>T</title></head><body><div id="wrap"><div id="hd"><a href="/">My blog</a></div><div id="menu"><a href="/a">Archive</a> <a href="/b">About me</a></div>
        <div class="post"><h2>On baking bread</h2><div class="entry"><p>I started to bake bread last winter, when the shops were closed.</p><p>The first loaf was flat. The second one was better.</p></div></div>
        <div id="sidebar"><h3>Blogroll</h3><ul><li><a href="x">A friend</a></li><li><a href="y">Another friend</a></li></ul></div><div id="footer">Powered by nothing. &copy; 2009</div></div></body></html>""",
        "On baking bread I started to bake bread last winter, when the shops were closed. The first loaf was flat. The second one was better.",
    ),
    (
        """<!doctype html><body><header><nav><a href=/>News</a><a href=/w>World</a></nav></header><main><article><header><h1>River rises again</h1></header>
        <p>The river rose by two metres on Monday, officials said.</p><aside class="related"><a href=/r>Read more: last year's flood</a></aside><p>Schools will stay closed until Thursday.</p></article></main>
        <div class="newsletter"><form><p>Get our newsletter every morning</p><input type=email><button>Sign up</button></form></div><footer><p>All rights reserved.</p></footer></body>""",
        "River rises again The river rose by two metres on Monday, officials said. Schools will stay closed until Thursday.",
    ),
    (
        """<table class="layout"><tr><td colspan=2><a href="index.html">Home</a> | <a href="links.html">Links</a></td></tr><tr><td class="menu"><a href="1.html">One</a><br><a href="2.html">Two</a></td>
        <td class="content"><h1>The history of the mill</h1>The mill was built in 1820 by two brothers, who came from the north.<br><br>It burned down in 1902 and was never built again.</td></tr></table><p class="copyright">Copyright 1999</p>""",
        "The history of the mill The mill was built in 1820 by two brothers, who came from the north. It burned down in 1902 and was never built again.",
    ),
    (
        """<body><div class="cookie-consent"><p>We value your privacy and use cookies.</p><button>Accept all</button></div><div class="main-content"><h1>How to tie a bowline</h1><ol><li>Make a small loop in the rope.</li><li>Bring the end up through the loop.</li><li>Take it round behind the rope and down again.</li></ol>
        <pre>end over loop, then under</pre></div><section class="comments"><h3>2 comments</h3><div class="comment"><b>Ann</b><p>This helped me a lot, thank you for writing it up so clearly.</p></div></section></body>""",
        "How to tie a bowline Make a small loop in the rope. Bring the end up through the loop. Take it round behind the rope and down again. end over loop, then under",
    ),
    (
        """<body><ul class="breadcrumb"><li><a href=/>Home</a><li><a href=/d>Docs</a></ul><article><h1>Install</h1><p>Run the <code>install</code> command, then <a href=/s>start the server</a>.</p><blockquote>Do this only once.</blockquote><table><tr><th>Port<td>80<tr><th>Host<td>all</table></article>
        <div class="share-bar"><a href=#>Tweet</a> <a href=#>Print</a></div><div class="ads"><p>Cheap hosting from five a month!</p></div></body>""",
        "Install Run the install command, then start the server. Do this only once. Port 80 Host all",
    ),
    ("""<body><nav><ul><li><a href=/a>A</a></li><li><a href=/b>B</a></li></ul></nav><form class="login"><label>Name</label><input><label>Password</label><input><button>Log in</button></form><footer>&copy; us</footer></body>""", ""),
]


def test_extraction_of_pages_made_by_hand(crf):
    got = html_extraction.extract(crf, [page for page, _ in HAND_MADE])
    assert got == [want for _, want in HAND_MADE]


def test_extraction_keeps_formulas_and_fallback_text(crf):
    held = "<p>The area is <math><mi>a</mi><mo>=</mo><mi>bc</mi></math> for a plain rectangle of these sides.</p><noscript><p>The chart shows how the area grows with both of the sides.</p></noscript><object data=x><p>The drawing shows a rectangle of these sides.</p></object><svg><text>side b</text><path d=x /></svg><p>The next paragraph of the story ends the article here.</p>"
    page = PAGE.replace("<p>Short.</p>", held)
    got = html_extraction.extract(crf, [page])[0]
    for told in ("The area is a=bc for a plain", "The chart shows how", "The drawing shows a rectangle", "side b", "ends the article here."):
        assert told in got
    assert "Menu one" not in got
    notice = PAGE.replace("<header", "<noscript>Please enable JavaScript.</noscript><header", 1)
    assert html_extraction.extract(crf, [notice]) == html_extraction.extract(crf, [PAGE])
