"""Line dedup by a deletion-neighbourhood join (operator 10, native).

A line is dropped if an earlier line, by (doc_id, line number), is equal to it
or within one word edit of it (a word inserted, deleted or replaced).  One word
of n leaves a similarity of 1 - 1 / n, which is 0.8 or more from five words on:
lines of under five words are dropped only for equal ones.  Words are the runs
between white space, so white space never tells lines apart; blank lines stay.

Equal lines first: each line's 128-bit hash keeps its earliest place, gathered
by document.  Then the neighbourhood.  Lines one edit apart share their first
or last floor(c / 2) words, c the smaller word count; only lines that share such
a half with another go on.  They emit their variants, one word of the other
half deleted, as hashed keys: a replaced word leaves equal variants with the
same place deleted, an inserted word leaves a variant equal to the whole of the
shorter line.  The keys of all of a line's variants come from running hashes,
so that a line costs its words (and a logarithm of them), not their square.  A
key keeps just its earliest line (a partial aggregate, so a key shared by many
costs no more), each other line of the key is held against that one by its
words, and goes if the edit distance is at most one.

Sides are broadcast only up to BROADCAST_ROWS rows of BROADCAST_CHARS characters
in all, counted first; beyond, they are joined by a shuffle, with the same
result.

Defined results: a null text stays null and an empty one empty; documents that
lose every line stay, with what blank lines they had; a document with a null
doc_id is left whole and drops nothing; rows that share a doc_id are documents
of their own, told apart and ordered by their text's hash (wholly equal ones
count as one and keep the same lines); an empty table gives an empty result;
all other columns pass through untouched, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basewise.llm.common import let, running, small, written

MIN_WORDS = 5
BROADCAST_ROWS, BROADCAST_CHARS = 200_000, 20_000_000
LINE_SPAN, TEXT_SPAN = 1 << 32, 1 << 26
#: White space within a line, the space first.
SPACES = " \t\r\x0b\f"
#: What a row of a variant key stands for.
REPLACED, WHOLE, DELETED = 0, 1, 2
#: Whether a line is the longer of its pair: no, yes, in some pairs.
EQUAL, LONGER, EITHER = 0, 1, 2


def _key(doc_id: str, text: str) -> Column:
    """A row's place among documents as one ordered number."""
    own = F.xxhash64(text).bitwiseAND(F.lit(TEXT_SPAN - 1))
    return F.col(doc_id).cast("decimal(20,0)") * F.lit(TEXT_SPAN).cast("decimal(8,0)") + own


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc, text, row): the row's place, its text and its other columns.

    Only these three names are used from here on, whatever docs' columns are.
    """
    rest = [docs[f"`{c}`"] for c in docs.columns if c != text]
    return docs.select(_key(doc_id, text).alias("doc"), docs[f"`{text}`"].alias("text"), F.struct(*rest).alias("row"))


def _unkeyed(held: DataFrame, columns: list[str], text: str) -> DataFrame:
    return held.select(*((F.col("text") if c == text else F.col("row").getField(c)).alias(c) for c in columns))


def _at() -> Column:
    """A line's place as one ordered number: its document's, then its own."""
    return F.col("doc") * F.lit(LINE_SPAN).cast("decimal(10,0)") + F.col("line")


def _doc(at: str) -> Column:
    return F.expr(f"cast(({at} - pmod({at}, {LINE_SPAN})) / {LINE_SPAN} as decimal(29,0))")


def _line(at: str) -> Column:
    return F.pmod(at, F.lit(LINE_SPAN).cast("decimal(38,0)")).cast("int")


def _flat(text: Column) -> Column:
    """A text with one space between words; most texts need no regex for it.

    Done once a text: its lines then need no more than a trim.
    """
    odd = text.contains("  ")
    for c in SPACES[1:]:
        odd = odd | text.contains(c)
    return F.when(odd, F.regexp_replace(text, rf"[{SPACES}]+", " ")).otherwise(text)


def _blank(raw: Column) -> Column:
    return F.btrim(raw, F.lit(SPACES)) == ""


def _lines(held: DataFrame) -> DataFrame:
    """(doc, line, flat) of all lines that are not blank."""
    # explode would infer a filter, and so do the work within it twice.
    rows = held.where(F.col("doc").isNotNull()).select("doc", F.posexplode_outer(F.split(_flat(F.col("text")), "\n")).alias("line", "raw"))
    return rows.select("doc", "line", F.trim("raw").alias("flat")).where("flat <> ''")


def _only(kept: Column) -> Column:
    """text with only the kept line numbers, which ascend."""
    lines = let(F.split("text", "\n"), lambda parts: F.array_join(F.transform(kept, lambda i: F.get(parts, i)), "\n"))
    return F.when(F.col("doc").isNull(), F.col("text")).otherwise(lines)


def _without_repeats(held: DataFrame) -> DataFrame:
    """held without lines that are equal to an earlier one."""
    rows = _lines(held)
    first = rows.groupBy(F.xxhash64("flat").alias("h"), F.xxhash64("flat", F.lit(1)).alias("g")).agg(F.min(_at()).alias("at"))
    first = first.groupBy(_doc("at").alias("of")).agg(F.collect_list(_line("at")).alias("kept"))
    joined = held.join(first, F.col("doc") == F.col("of"), "left")
    blank = F.filter(F.transform(F.split("text", "\n"), lambda x, i: F.when(_blank(x), i).otherwise(-1)), lambda i: i >= 0)
    kept = F.sort_array(F.array_union(F.coalesce("kept", F.array().cast("array<int>")), blank))
    return joined.select("doc", _only(kept).alias("text"), "row")


def drop_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs without lines that are equal to an earlier one."""
    return _unkeyed(_without_repeats(_keyed(docs, doc_id, text)), docs.columns, text)


def _halves() -> Column:
    """Keys of the halves that a line of n words may share with a neighbour.

    The half is that of the pair's smaller word count: n, or n - 1 where this
    line is the longer.  An odd n has the same halves either way.
    """

    def told(role: int, half: Column) -> list[Column]:
        cut = lambda part: F.call_function("substring_index", F.col("flat"), F.lit(" "), part)
        return [F.struct(F.xxhash64(F.lit(s), cut(part)).alias("half"), F.lit(role).alias("longer"), F.lit(s).alias("side")) for s, part in ((0, half), (1, -half))]

    half = F.floor(F.col("n") / 2).cast("int")
    return F.when(F.col("n") % 2 == 1, F.array(*told(EITHER, half))).otherwise(F.array(*told(EQUAL, half), *told(LONGER, half - 1)))


def _variants(words: Column, half: Column, longer: Column, side: Column) -> Column:
    """Variant keys of a line, one side of which is shared.

    half, the shared side's key, stands for its words; only words of the rest
    are deleted.  A word list's hash is the exclusive-or of its words', each
    taken with its place; behind a deleted word the others are a place lower.
    """
    kept = F.floor((F.size(words) - (longer == LONGER).cast("int")) / 2).cast("int")
    rest = F.when(side == 0, F.slice(words, kept + 1, F.size(words))).otherwise(F.slice(words, F.lit(1), F.size(words) - kept))
    none = F.lit(0).cast("long")
    total = lambda a: F.aggregate(a, none, lambda n, x: n.bitwiseXOR(x))

    def key(kind: int, *parts: Column) -> Column:
        return F.xxhash64(half, F.lit(kind), *parts).alias("key")

    def of(w: Column) -> Column:
        here, lower = F.transform(w, lambda x, i: F.xxhash64(x, i)), F.transform(w, lambda x, i: F.xxhash64(x, i - 1))

        def same_length(a: Column) -> Column:
            whole = total(a)
            replaced = let(whole, lambda t: F.transform(a, lambda x, i: F.struct(key(0, i, t.bitwiseXOR(x)), F.lit(REPLACED).alias("role"))))
            return F.concat(replaced, F.array(F.struct(key(1, whole), F.lit(WHOLE).alias("role"))))

        def shorter(a: Column) -> Column:
            # Those before the word in their places, those behind it lower.
            both = let(F.zip_with(a, lower, lambda x, y: x.bitwiseXOR(y)), lambda both: running(both, lambda x, y: x.bitwiseXOR(y)))
            behind = let(total(lower), lambda t: F.zip_with(both, a, lambda run, x: t.bitwiseXOR(run).bitwiseXOR(x)))
            return F.transform(behind, lambda v: F.struct(key(1, v), F.lit(DELETED).alias("role")))

        return let(here, lambda a: F.when(longer == LONGER, shorter(a)).when(longer == EQUAL, same_length(a)).otherwise(F.concat(same_length(a), shorter(a))))

    return let(rest, of)


def _within_one(a: Column, b: Column) -> Column:
    """Whether two word lists are within one inserted, deleted or replaced word."""
    low = F.least(F.size(a), F.size(b))
    unlike = F.array_position(F.zip_with(F.slice(a, F.lit(1), low), F.slice(b, F.lit(1), low), lambda x, y: x != y), True).cast("int")
    same = F.when(unlike == 0, low).otherwise(unlike - 1)

    def rest(x: Column, skip: Column) -> Column:
        return F.slice(x, same + 1 + skip, F.size(x))

    cut_a = (F.size(a) >= F.size(b)).cast("int")
    cut_b = (F.size(b) >= F.size(a)).cast("int")
    return (F.abs(F.size(a) - F.size(b)) <= 1) & (rest(a, cut_a) == rest(b, cut_b))


def _small(df: DataFrame, name: str, width: str = "0L") -> DataFrame:
    return small(df, name, BROADCAST_ROWS, BROADCAST_CHARS, width)


def _near(held: DataFrame) -> DataFrame:
    """(at): lines within one word edit of an earlier, other line.

    held is a table that is read twice; its lines are distinct.
    """
    n = (F.length("flat") - F.length(F.replace(F.col("flat"), F.lit(" "), F.lit(""))) + 1).alias("n")
    rows = _lines(held).select(_at().alias("at"), "flat", n).where(F.col("n") >= MIN_WORDS)
    halves = rows.select("at", "flat", F.explode_outer(_halves()).alias("h"))
    # A line's own halves differ, so rows of a half are distinct lines.
    shared = _small(halves.groupBy("h.half").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select(F.col("half").alias("with")), "halves")
    lines = written(halves.join(shared, F.col("h.half") == F.col("with"), "left_semi").select("at", "flat", "h.half", "h.longer", "h.side"), "neighbours")
    words = F.split("flat", " ")
    variants = lines.select("at", F.explode_outer(let(words, lambda w: _variants(w, F.col("half"), F.col("longer"), F.col("side")))).alias("v"))
    variants = variants.select("at", F.col("v.key").alias("key"), F.col("v.role").alias("role"))

    def least(*roles: int) -> Column:
        return F.min(F.when(F.col("role").isin(*roles), F.col("at")))

    groups = variants.groupBy("key").agg(F.count(F.lit(1)).alias("rows"), least(REPLACED).alias("r"), least(WHOLE).alias("f"), least(DELETED).alias("x"))
    groups = _small(groups.where("rows > 1 and (r is not null or (f is not null and x is not null))").select(F.col("key").alias("of"), "r", "f", "x"), "keys")
    earliest = reduce(lambda out, at: F.when(F.col("role") == at[0], F.col(at[1])).otherwise(out), ((WHOLE, "x"), (DELETED, "f")), F.col("r"))
    pairs = written(variants.join(groups, variants.key == F.col("of")).select("at", earliest.alias("first")).where("first < at").distinct(), "pairs")
    side = F.broadcast if 2 * pairs.count() <= BROADCAST_ROWS else (lambda df: df)
    # The earliest line of a key shares a half, so it is among the lines as well.
    asked = side(pairs.select("at").union(pairs.select("first")).distinct().withColumnRenamed("at", "of"))
    texts = _small(lines.join(asked, F.col("at") == F.col("of"), "left_semi").groupBy("at").agg(F.first("flat").alias("flat")), "texts", "length(flat)")
    mine, theirs = texts.select(F.col("at").alias("of"), F.col("flat").alias("u")), texts.select(F.col("at").alias("by"), F.col("flat").alias("v"))
    met = pairs.join(mine, F.col("at") == F.col("of")).join(theirs, F.col("first") == F.col("by"))
    return met.where(_within_one(F.split("u", " "), F.split("v", " "))).select("at").distinct()


def _without_near(held: DataFrame) -> DataFrame:
    """held, whose lines are distinct, without near-equal later lines."""
    lost = _small(_near(held).groupBy(_doc("at").alias("of")).agg(F.collect_list(_line("at")).alias("lost")), "lost", "size(lost)")
    joined = held.join(lost, F.col("doc") == F.col("of"), "left")
    numbers = F.transform(F.split("text", "\n"), lambda x, i: i)
    return joined.select("doc", F.when(F.col("lost").isNull(), F.col("text")).otherwise(_only(F.array_except(numbers, "lost"))).alias("text"), "row")


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with each line only where it, or its like, came first."""
    held = written(_without_repeats(_keyed(docs, doc_id, text)), "lines")
    return _unkeyed(_without_near(held), docs.columns, text)


def op10_lines(docs: DataFrame) -> DataFrame:
    """doc_id, text and n_lines (of that text) for every document."""
    kept = dedup_lines(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")))
    return kept.withColumn("n_lines", F.coalesce(F.size(F.filter(F.split("text", "\n"), lambda x: ~_blank(x))), F.lit(0)).cast("long"))
