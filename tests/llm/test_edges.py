"""Every operator on empty tables, null columns, very long texts, repeated rows
and extra columns whose names it uses itself."""

import random
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from basewise.llm import decontamination, html_extraction, kdtree_search, language_id, line_dedup, packing, quality, simhash_dedup, simhash_similar, token_counts, toxicity

OWN = "__id __k __lost __kept of by k g h p x y n w fp pos at size starts start doc row line flat half key root node component first least named value shard region vec_id rank score held_out predicted fingerprint component_id".split()
DOC = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in OWN)
LABEL = "doc_id long, quality int, toxic int"
WORDS = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor".split()


def tables(spark, rows, labels=()):
    docs = spark.createDataFrame([(i, t, lang, "s", len(t or ""), *OWN) for i, t, lang in rows], DOC)
    return docs, spark.createDataFrame(list(labels), LABEL), spark.createDataFrame([(1, " ".join(WORDS)), (None, None)], "item_id long, text string")


#: Operators with a row of their own for each row of documents.
ROWWISE = {
    "op4": lambda d, labels, items: language_id.op4_language(d),
    "op6": lambda d, labels, items: token_counts.op6_count(d),
    "op7": lambda d, labels, items: simhash_dedup.op7_simhash(d),
    "op8": lambda d, labels, items: toxicity.op8_toxicity(d, labels),
    "op9": lambda d, labels, items: quality.op9_quality(d, labels),
    "op10": lambda d, labels, items: line_dedup.op10_lines(d),
}
ALL = ROWWISE | {
    "op3": lambda d, labels, items: decontamination.op3_contaminated(d, items),
    "op5": lambda d, labels, items: packing.op5_pack(d),
    "without_toxic": lambda d, labels, items: toxicity.without_toxic(d, labels),
    "dedup_lines": lambda d, labels, items: line_dedup.dedup_lines(d),
    "one_of_each_group": lambda d, labels, items: simhash_similar.one_of_each_group(d),
    "without_benchmark": lambda d, labels, items: decontamination.without_benchmark(d, items),
}
#: Those that hand documents on.
STAGES = ("without_toxic", "dedup_lines", "one_of_each_group", "without_benchmark")


def mixed(rng, n=60):
    rows = [(i, " ".join(rng.choice(WORDS) for _ in range(rng.randint(1, 60))), rng.choice(["aa", "bb"])) for i in range(n)]
    return rows, [(i, i % 3 % 2, int(i % 4 == 0)) for i in range(n)]


@pytest.mark.parametrize("name", ALL)
def test_empty_tables(spark, name):
    docs, labels, items = tables(spark, [])
    got = ALL[name](docs, labels, items)
    assert got.count() == 0 and (name not in STAGES or got.columns == docs.columns)
    some, labels = mixed(random.Random(1), 6)
    docs, labels, items = tables(spark, some, labels)
    assert ALL[name](docs, labels.where("false"), items.where("false")).count() >= 0


@pytest.mark.parametrize("name", ALL)
def test_nulls_repeats_and_names(spark, name):
    """Nulls in any column; every repeated row has its row; columns whose names
    the operator uses itself stay as they are."""
    rows, labels = mixed(random.Random(2), 40)
    rows += [(None, None, None), (None, "some text here", None), (70, None, "aa"), (71, "", None), (None, None, None), *rows[:5], *rows[:2]]
    labels += [(None, None, None), (None, 1, 1), (3, None, None), (4, None, 1), (3, 0, 1), *labels[:3]]
    docs, labels, items = tables(spark, rows, labels)
    blank = docs.where("doc_id = 11").select(F.lit(None).cast("long").alias("doc_id"), *(F.lit(None).cast(f.dataType).alias(f.name) for f in docs.schema.fields[1:]))
    got = ALL[name](docs.union(blank), labels, items)
    if name in ROWWISE:
        assert Counter(r.doc_id for r in got.select("doc_id").collect()) == Counter([i for i, _, _ in rows] + [None])
    elif name in STAGES:
        assert got.columns == docs.columns
        held = got.collect()
        assert any(r.doc_id is None for r in held) and all(tuple(r[c] for c in OWN) in (tuple(OWN), (None,) * len(OWN)) for r in held)
    else:
        got.collect()


@pytest.mark.parametrize("name", ALL)
def test_very_long_texts(spark, name):
    """A text of two million characters, in one line and in many."""
    rng = random.Random(4)
    words = [rng.choice(WORDS) + str(rng.randrange(5000)) for _ in range(200_000)]
    rows, labels = mixed(rng, 40)
    rows += [(100, " ".join(words), "aa"), (101, "\n".join(" ".join(words[i : i + 9]) for i in range(0, len(words), 9)), "bb"), (102, "x" * 2_000_000, "aa"), (103, "a " * 50_000, "bb")]
    docs, labels, items = tables(spark, rows, labels)
    began = time.time()
    got = ALL[name](docs, labels, items)
    if name in ROWWISE:
        assert got.count() == docs.count()
    else:
        got.collect()
    assert time.time() - began < 120


def test_pages_and_vectors_at_the_edges(spark):
    schema = "page_id long, url string, html string, " + ", ".join(f"`{c}` string" for c in ["text", "n_chars", *OWN])
    row = lambda i, h: (i, None, h, *(["text", "n_chars", *OWN]))
    pages = spark.createDataFrame([row(1, None), row(None, ""), row(2, "<p>" * 10), row(2, "<p>" * 10), row(3, "<article><p>" + "word " * 400_000 + "</p></article>")], schema)
    got = {r.page_id: (r.text, r.n_chars) for r in html_extraction.op1_extract(pages).collect()}
    assert got[1] == got[None] == got[2] == ("", 0) and got[3][1] == 5 * 400_000 - 1
    assert html_extraction.op1_extract(pages.where("false")).count() == 0 and html_extraction.op1_extract(pages).count() == 5
    vectors = spark.createDataFrame([(i, [float(i % 7), 1.0], *OWN[:3]) for i in (0, 20, 20, 21, 22)] + [(None, [1.0, 1.0], *OWN[:3]), (40, [], *OWN[:3])], "vec_id long, embedding array<double>, `row` string, shard string, region string")
    got = Counter(r.query_id for r in kdtree_search.op2_kdtree(vectors).collect())
    assert got == Counter({0: 5, 20: 10, 40: 5})


def test_ties(spark):
    """Equal scores, shares and similarities have one answer."""
    docs, labels, items = tables(spark, [(i, "same words in every text", "aa" if i % 2 else "bb") for i in range(30)], [(i, i % 2, i % 2) for i in range(30)])
    for name in ("op4", "op8", "op9"):
        got = ROWWISE[name](docs, labels, items).collect()
        assert len({round(r.score, 6) for r in got}) == 1 and len(got) == 30
    assert {r.component_id for r in simhash_dedup.op7_simhash(docs).collect()} == {0}
    assert [r.doc_id for r in simhash_similar.one_of_each_group(docs).collect()] == [0]
    two = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f")], "item_id long, text string")
    held = spark.createDataFrame([(5, "x a b c d e f y"), (6, "a b c d e f a b c d e f")], "doc_id long, text string")
    assert {(r.doc_id, r.item_id, r.similarity) for r in decontamination.op3_contaminated(held, two).collect()} == {(d, i, 1.0) for d in (5, 6) for i in (1, 2)}
