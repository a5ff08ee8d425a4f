"""Benchmark decontamination by SimHash windows (operator 3, native).

Words are runs of letters, marks and digits in lower case.  A window is an
item's count of words in a document; it may stick out at either end, and then
holds what there is.  Each window and item has a 64-bit SimHash of its shingles
of five words, repeats included.  A multi-index over eight blocks of eight bits,
items entered with every block changed by up to two bits, finds every item of
the window's size whose fingerprint is within RADIUS = 23 bits: of 23 differing
bits, some block holds at most two.  The pairs are then held to the exact
weighted Jaccard similarity of their shingles (the sum of the lesser counts over
the sum of the greater), 0.8 or more.  A pair's similarity is the greatest of
all its windows.

Not every window is fingerprinted, but none that could count is left out.  A
window needs so many shingles that items of its size hold; moved right to the
first of them (or, where it sticks out in front, left to end with the last) it
keeps them all and gets no longer.  So the windows at such shingles, if enough
of them lie in an item's size, give the greatest similarity of all.

The items' shingles are broadcast up to BROADCAST_ROWS rows, counted first;
beyond, they meet the documents' by a shuffle in which each shingle is dealt
over SALTS tasks, with the same result.

Defined results: documents and items that are null or have under five words
match nothing; repeated rows of a document or an item count once; rows that
share a doc_id count together, those of a null doc_id under null; ties keep the
greatest similarity; empty tables give an empty result; extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basewise.llm.common import let, running, small

WORDS, SIMILARITY, RADIUS = 5, 0.8, 23
BLOCKS, BLOCK_BITS = 8, 8
BROADCAST_ROWS = 200_000
#: Tasks that a shingle is dealt over where the items' are too many to broadcast.
SALTS = 8


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{M}\p{N}]+"), lambda w: w != "")


def _shingles(w: Column, of: Callable[..., Column]) -> Column:
    """of(five words) at each place; none under five words.

    Words are taken one by one: a slice would cost the whole array's length.
    """

    def at(words: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(words) - WORDS)
        return F.when(F.size(words) >= WORDS, F.transform(places, lambda i: of(*(F.get(words, i + k) for k in range(WORDS)))))

    return let(w, at)


def _hashes(w: Column) -> Column:
    return _shingles(w, F.xxhash64)


def _bag(w: Column) -> Column:
    """Shingles, each with the count of its like before it: a multiset as a set."""

    def counted(ordered: Column) -> Column:
        # The last place up to each where a new shingle begins.
        new = F.transform(ordered, lambda x, i: F.when((i == 0) | (x != F.get(ordered, F.greatest(i - 1, F.lit(0)))), i).otherwise(F.lit(0)))
        begun = let(new, lambda a: running(a, F.greatest))
        return let(begun, lambda at: F.transform(ordered, lambda x, i: F.concat_ws(" ", x, (i - F.get(at, i)).cast("string"))))

    return let(F.sort_array(_shingles(w, lambda *x: F.concat_ws(" ", *x))), counted)


def simhash(hashes: Column) -> Column:
    """The bits set in over half the hashes, as a long."""
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")

    def fingerprint(held: Column) -> Column:
        def bit(b: Column) -> Column:
            ones = F.aggregate(held, none, lambda n, h: n + F.call_function("shiftright", h, b).bitwiseAND(one))
            return F.when(ones * 2 > F.size(held), F.call_function("shiftleft", one, b)).otherwise(none)

        bits = F.transform(F.sequence(F.lit(0), F.lit(63)), bit)
        return F.aggregate(bits, none, lambda n, x: n.bitwiseOR(x))

    # Never null, or filters inferred from it would work it out once more.
    return F.coalesce(let(hashes, fingerprint), none)


def _blocks(fp: Column, flips: bool) -> Column:
    """The multi-index keys of a fingerprint: (block, its bits, maybe up to two changed)."""
    one = [1 << b for b in range(BLOCK_BITS)]
    masks = sorted({a ^ b for a in (0, *one) for b in (0, *one)}) if flips else [0]
    return F.array(
        *(
            F.struct(F.lit(i).alias("i"), F.shiftrightunsigned(fp, i * BLOCK_BITS).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)).bitwiseXOR(F.lit(m)).alias("b"))
            for i in range(BLOCKS)
            for m in masks
        )
    )


def _starts(hits: DataFrame) -> DataFrame:
    """(k, g, size, starts): where a document's windows of a size start.

    hits are the document's shingles that items of the size hold: (k, g, words,
    size, pos, at), at null if not the same in all of them.  A window is taken
    at each hit, and before the first word up to each hit, if so many hits lie
    in it as SIMILARITY asks for.  If all hits line up at one start, its window
    holds all that a whole window can, and is the only whole one needed.
    """
    lined = F.col("pos") - F.col("at")
    held = hits.groupBy("k", "g", "words", "size").agg(
        F.array_sort(F.collect_list("pos")).alias("p"), F.when((F.count("at") == F.count("pos")) & (F.min(lined) == F.max(lined)), F.min(lined)).alias("one")
    )
    size, own = F.col("size"), F.col("size") - (WORDS - 1)
    need = F.greatest(F.ceil(own * SIMILARITY - 1e-9).cast("int"), F.lit(1))
    # The hit by which the window that starts at the i-th has as many as needed.
    right = F.transform("p", lambda p, i: F.when((F.get("p", i + need - 1) < p + own) & (F.col("one").isNull() | (p + size > F.col("words"))), p))
    left = F.transform("p", lambda p, i: F.when((i + 1 >= need) & (p + WORDS < size), p + WORDS - size))
    starts = F.array_distinct(F.array_compact(F.concat(F.array("one"), right, left)))
    return held.where(F.size("p") >= need).select("k", "g", "size", starts.alias("starts")).where(F.size("starts") > 0)


def _windows(texts: DataFrame, grams: DataFrame, broadcast_rows: int) -> DataFrame:
    """(k, g, size, w): windows that can reach the similarity."""
    # Texts of under five words have a null shingle, which joins nothing: a filter
    # (explode brings its own) would split and hash every text twice.
    held = texts.select("k", "g", words_of(F.col("text")).alias("w")).select("k", "g", F.size("w").alias("words"), _hashes(F.col("w")).alias("hashes"))
    # The words' count is worked out below: no row carries the words themselves.
    placed = held.select("k", "g", "words", F.posexplode_outer("hashes").alias("pos", "h"))
    # Of repeated texts one is enough.
    placed = placed.withColumnsRenamed({"k": "dk", "g": "dg"})
    if grams.count() <= broadcast_rows:
        hits = placed.join(F.broadcast(grams), "h")
    else:
        dealt = grams.withColumn("salt", F.explode(F.array(*map(F.lit, range(SALTS)))))
        hits = placed.withColumn("salt", F.pmod("pos", F.lit(SALTS))).join(dealt, ["h", "salt"]).drop("salt")
    hits = hits.select(F.col("dk").alias("k"), F.col("dg").alias("g"), "words", "size", "pos", "at").distinct()
    starts = small(_starts(hits).withColumnsRenamed({"k": "of", "g": "by"}), "starts", broadcast_rows, width="size(starts)")
    # Only documents with a window are split into words again.
    met = texts.join(starts, (F.col("k") == F.col("of")) & (F.col("g") == F.col("by")))
    # A window starts at the document's first word at the earliest.  Cut before
    # they are told apart, so that no row repeats the whole document.
    size = F.col("size")
    cut = let(words_of(F.col("text")), lambda w: F.transform("starts", lambda s: F.transform(F.sequence(F.greatest(s, F.lit(0)), F.least(s + size, F.size(w)) - 1), lambda i: F.get(w, i))))
    return met.select("k", "g", "size", F.explode_outer(cut).alias("w")).distinct()


def _texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text, k, g): k and g are a text's two hashes, its key."""
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("k"), F.crc32(text.cast("binary")).alias("g"))


def _found(texts: DataFrame, items: DataFrame, broadcast_rows: int) -> DataFrame:
    """(k, g, item_id, similarity): items that texts hold."""
    held = items.select(F.col("item_id").cast("long").alias("item_id"), words_of(F.col("text").cast("string")).alias("w")).where(F.size("w") >= WORDS).distinct()
    grams = held.select(F.size("w").alias("size"), F.posexplode(_hashes(F.col("w"))).alias("at", "h"))
    grams = grams.groupBy("size", "h").agg(F.when(F.min("at") == F.max("at"), F.min("at")).alias("at"))
    windows = _windows(texts, grams, broadcast_rows).where(F.size("w") >= WORDS).withColumn("fp", simhash(_hashes(F.col("w"))))
    known = held.select("item_id", F.size("w").alias("size"), F.xxhash64("w").alias("ik"), simhash(_hashes(F.col("w"))).alias("ifp"), F.col("w").alias("iw"))
    entered = small(known.select("item_id", "size", "ik", "ifp", F.explode_outer(_blocks(F.col("ifp"), True)).alias("e")), "entered", broadcast_rows)
    asked = windows.select("k", "g", "size", "fp", "w", F.explode_outer(_blocks(F.col("fp"), False)).alias("e"))
    pairs = asked.join(entered, ["size", "e"]).where(F.bit_count(F.col("fp").bitwiseXOR(F.col("ifp"))) <= RADIUS)
    # A pair that several blocks find, and windows of the same words, count once.
    pairs = pairs.select("k", "g", "item_id", "ik", "w").distinct()
    bags = small(known.select(F.col("ik").alias("of"), _bag(F.col("iw")).alias("ibag")).distinct(), "items", broadcast_rows, width="size(ibag)")
    seen = pairs.join(bags, F.col("ik") == F.col("of")).select("k", "g", "item_id", _bag(F.col("w")).alias("bag"), "ibag")
    both = seen.select("k", "g", "item_id", F.size(F.array_intersect("bag", "ibag")).alias("both"), (F.size("bag") + F.size("ibag")).alias("all"))
    scored = both.select("k", "g", "item_id", (F.col("both") / (F.col("all") - F.col("both"))).alias("similarity"))
    return scored.where(F.col("similarity") >= SIMILARITY).groupBy("k", "g", "item_id").agg(F.max("similarity").alias("similarity"))


def contaminated(docs: DataFrame, items: DataFrame, broadcast_rows: int | None = None) -> DataFrame:
    """(doc_id, text) x (item_id, text) -> (doc_id, item_id, similarity)."""
    texts = _texts(docs)
    rows = BROADCAST_ROWS if broadcast_rows is None else broadcast_rows
    found = small(_found(texts, items, rows).withColumnsRenamed({"k": "of", "g": "by"}), "found", rows)
    named = texts.select("doc_id", "k", "g").join(found, (F.col("k") == F.col("of")) & (F.col("g") == F.col("by")))
    return named.groupBy("doc_id", "item_id").agg(F.max("similarity").alias("similarity"))


def op3_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per document and benchmark item that it holds."""
    return contaminated(docs, items)


def without_benchmark(docs: DataFrame, items: DataFrame, broadcast_rows: int | None = None) -> DataFrame:
    """Rows whose text holds no benchmark item; all columns stay.

    Each row is judged by its own text, whatever rows share its doc_id.
    """
    rows = BROADCAST_ROWS if broadcast_rows is None else broadcast_rows
    lost = small(_found(_texts(docs), items, rows).select(F.col("k"), F.col("g")).distinct(), "lost", rows)
    text = docs["text"].cast("string")
    return docs.join(lost, (F.xxhash64(text) == lost["k"]) & (F.crc32(text.cast("binary")) == lost["g"]), "left_anti")
