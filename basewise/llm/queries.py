"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from basewise.llm.decontamination import op3_contaminated
from basewise.llm.html_extraction import op1_extract
from basewise.llm.kdtree_search import op2_kdtree
from basewise.llm.language_id import op4_language
from basewise.llm.line_dedup import op10_lines
from basewise.llm.packing import op5_pack
from basewise.llm.quality import op9_quality
from basewise.llm.simhash_dedup import op7_simhash
from basewise.llm.token_counts import op6_count
from basewise.llm.toxicity import op8_toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op1_extract(_table(spark, sf_dir, "pages"))


def op2_kdtree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op2_kdtree(_table(spark, sf_dir, "embeddings"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op3_contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4_language(_table(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op5_pack(_table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op6_count(_table(spark, sf_dir, "documents"))


def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op7_simhash(_table(spark, sf_dir, "documents"))


def op8_toxicity_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op8_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_quality_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op9_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10_lines(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_html_extraction,
        op2_kdtree_search,
        op3_decontamination,
        op4_language_id,
        op5_packing,
        op6_token_counts,
        op7_simhash_dedup,
        op8_toxicity_pu,
        op9_quality_mil,
        op10_line_dedup,
    )
}

#: floor(64 x) and every inner product of two rows, ranked.
_OP2 = """
WITH v AS (
  SELECT vec_id, row_number() OVER () AS id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, q.id, c.vec_id AS vec_id, CAST(list_dot_product(q.e::DOUBLE[], c.e::DOUBLE[]) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.id <> q.id),
r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""

#: Every window of an item's size in every document that shares enough shingles
#: with the item at all, by weighted Jaccard similarity, without fingerprints.
_OP3 = r"""
WITH d AS (
  SELECT *, row_number() OVER () AS r FROM (
    SELECT DISTINCT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{M}\p{N}]+'), lambda w: w <> '') AS w FROM documents WHERE text IS NOT NULL)),
b AS (
  SELECT DISTINCT item_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{M}\p{N}]+'), lambda w: w <> '') AS w FROM benchmark WHERE text IS NOT NULL),
gs AS (
  SELECT item_id, w AS iw, array_to_string(w[u.i : u.i + 4], ' ') AS s, count(*) AS n
  FROM b, unnest(range(1, len(w) - 3)) u(i) WHERE len(w) >= 5 GROUP BY ALL),
gn AS (SELECT item_id, iw, CAST(sum(n) AS BIGINT) AS n FROM gs GROUP BY ALL),
ds AS (
  SELECT r, array_to_string(w[u.i : u.i + 4], ' ') AS s, count(*) AS n
  FROM d, unnest(range(1, len(w) - 3)) u(i) WHERE len(w) >= 5 GROUP BY ALL),
pr AS (
  SELECT r, gs.item_id, gs.iw, gn.n FROM ds JOIN gs USING (s) JOIN gn ON gn.item_id = gs.item_id AND gn.iw = gs.iw
  GROUP BY r, gs.item_id, gs.iw, gn.n HAVING sum(least(ds.n, gs.n)) >= 0.8 * gn.n),
win AS (
  SELECT pr.r, doc_id, item_id, iw, n, u.i AS begin, w[greatest(u.i, 0) + 1 : u.i + len(iw)] AS w
  FROM pr JOIN d USING (r), unnest(range(5 - len(iw), len(w) - 4)) u(i)),
ws AS (
  SELECT r, doc_id, item_id, iw, win.n AS own, begin, len(w) - 4 AS size, array_to_string(w[u.i : u.i + 4], ' ') AS s, count(*) AS n
  FROM win, unnest(range(1, len(w) - 3)) u(i) GROUP BY ALL),
met AS (
  SELECT ws.doc_id, ws.item_id, CAST(sum(least(ws.n, gs.n)) AS DOUBLE) AS common, any_value(own + size) AS total
  FROM ws JOIN gs ON ws.s = gs.s AND ws.item_id = gs.item_id AND ws.iw = gs.iw GROUP BY ws.r, ws.doc_id, ws.item_id, ws.iw, ws.begin)
SELECT doc_id, item_id, max(common / (total - common)) AS similarity FROM met WHERE common / (total - common) >= 0.8 GROUP BY doc_id, item_id
"""

#: Lines against all earlier lines that share their first or last word: one
#: word edit leaves one of the two.
_OP10 = r"""
WITH raw AS (
  SELECT doc_id, u.i - 1 AS line, string_split(text, chr(10))[u.i] AS raw
  FROM documents, unnest(range(1, len(string_split(text, chr(10))) + 1)) u(i) WHERE text IS NOT NULL),
l AS (
  SELECT doc_id, line, raw, trim(regexp_replace(raw, '[ \t\n\x0B\f\r]+', ' ', 'g'), ' ') AS flat FROM raw),
f AS (
  SELECT doc_id, line, flat, string_split(flat, ' ') AS w
  FROM l WHERE flat <> '' QUALIFY row_number() OVER (PARTITION BY flat ORDER BY doc_id, line) = 1),
e AS (SELECT *, len(w) AS n, w[1] AS a, w[len(w)] AS z FROM f WHERE len(w) >= 5),
c AS (
  SELECT y.doc_id, y.line, y.w AS v, x.w AS u FROM e y JOIN e x
    ON x.a = y.a AND abs(x.n - y.n) <= 1 AND (x.doc_id < y.doc_id OR (x.doc_id = y.doc_id AND x.line < y.line))
  UNION ALL
  SELECT y.doc_id, y.line, y.w, x.w FROM e y JOIN e x
    ON x.z = y.z AND abs(x.n - y.n) <= 1 AND (x.doc_id < y.doc_id OR (x.doc_id = y.doc_id AND x.line < y.line))),
m AS (
  SELECT *, coalesce(list_position(list_transform(range(1, least(len(u), len(v)) + 1), lambda i: u[i] <> v[i]), true), least(len(u), len(v)) + 1) AS i FROM c),
near AS (
  SELECT DISTINCT doc_id, line FROM m
  WHERE (len(u) = len(v) AND u[i + 1 :] = v[i + 1 :]) OR (len(u) > len(v) AND u[i + 1 :] = v[i :]) OR (len(u) < len(v) AND u[i :] = v[i + 1 :])),
k AS (
  SELECT l.doc_id, l.line, l.raw, l.flat FROM l
    LEFT JOIN f ON l.doc_id = f.doc_id AND l.line = f.line
    LEFT JOIN near ON l.doc_id = near.doc_id AND l.line = near.line
  WHERE l.flat = '' OR (f.doc_id IS NOT NULL AND near.doc_id IS NULL)),
t AS (
  SELECT doc_id, string_agg(raw, chr(10) ORDER BY line) AS text, count(*) FILTER (flat <> '') AS n_lines FROM k GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(t.text, '') END AS text, CAST(coalesce(t.n_lines, 0) AS BIGINT) AS n_lines
FROM documents d LEFT JOIN t ON d.doc_id = t.doc_id
"""

ORACLES: dict[str, str] = {"op2_kdtree_search": _OP2, "op3_decontamination": _OP3, "op10_line_dedup": _OP10}
