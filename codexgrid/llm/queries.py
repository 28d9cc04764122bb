"""Registered queries of the training-data operators and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codexgrid.llm import alignment, leakage, mixture, pairs, scans, sigtree, splitting, truncation
from codexgrid.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


@query
def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation.truncated_values(table(spark, sf_dir, "structured")).select("block_id", "field_name")


@query
def p5_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation.truncation_report(table(spark, sf_dir, "structured"))


def _blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "structured").filter(F.coalesce("type", F.lit("paragraph")) != "image")


@query
def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sigtree.similar_pairs(_blocks(spark, sf_dir)).select("block_id_a", "block_id_b")


@query
def p3_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sigtree.similar_records(_blocks(spark, sf_dir))


@query
def p3_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The compact form of p3_found: classes of equal texts and links between different ones."""
    return sigtree.similar_records(_blocks(spark, sf_dir), k=3, t=0.6, least_words=40)


@query
def p8_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.mixture(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))


@query
def p8_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.mixture_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))


@query
def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splitting.split_oversized(table(spark, sf_dir, "documents")).filter("piece_no = 1").select("doc_id").distinct()


@query
def p9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splitting.split_oversized(table(spark, sf_dir, "documents"))


@query
def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = leakage.leaked_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))
    return found.filter("kind = 'verbatim'").select("doc_id", "item_id")


@query
def p7_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leakage.leaked_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


@query
def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.broken_pairs(table(spark, sf_dir, "structured").filter("status = 'done'"))


@query
def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "structured").filter("status = 'translated'")
    return alignment.aligned_sentences(rows, glossary=table(spark, sf_dir, "glossary")).select("block_id", "text_no", "trans_no")


@query
def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.scan_noise(_blocks(spark, sf_dir))


@query
def p1_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.repaired_records(_blocks(spark, sf_dir))


SQL["p3_found"] = r"""
WITH r AS (SELECT block_id, any_value(title) AS title, any_value(text) AS text FROM structured WHERE coalesce(type, '') <> 'image' GROUP BY block_id),
d AS (SELECT block_id, regexp_extract_all(lower(coalesce(title, '') || ' ' || coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM r),
t AS (SELECT DISTINCT block_id, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT block_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 40)),
n AS (SELECT block_id, count(*) AS n FROM t GROUP BY block_id),
c AS (SELECT a.block_id AS a, b.block_id AS b, count(*) AS k FROM t a JOIN t b ON a.g = b.g AND a.block_id < b.block_id GROUP BY ALL)
SELECT c.a AS block_id_a, c.b AS block_id_b FROM c JOIN n x ON x.block_id = c.a JOIN n y ON y.block_id = c.b WHERE c.k * 10 >= 6 * (x.n + y.n - c.k)
"""
def _records_sql(k: int, tenths: int, least: int) -> str:
    """Classes of equal texts and links between different ones, by counting common shingles."""
    shingle = " || ' ' || ".join(["w[i]", *(f"w[i + {j}]" for j in range(1, k))])
    return rf"""
WITH r AS (SELECT block_id, any_value(title) AS title, any_value(text) AS text FROM structured WHERE coalesce(type, '') <> 'image' GROUP BY block_id),
d AS (SELECT block_id, regexp_extract_all(lower(coalesce(title, '') || ' ' || coalesce(text, '')), '[\p{{L}}\p{{N}}]+') AS w FROM r),
m AS (SELECT block_id, w, min(block_id) OVER (PARTITION BY w) AS class_id, count(*) OVER (PARTITION BY w) AS class_size FROM d WHERE len(w) >= {least}),
t AS (SELECT DISTINCT class_id, {shingle} AS g FROM (SELECT class_id, w, unnest(range(1, len(w) - {k - 2})) AS i FROM m WHERE block_id = class_id)),
n AS (SELECT class_id, count(*) AS n FROM t GROUP BY class_id),
c AS (SELECT a.class_id AS a, b.class_id AS b, count(*) AS k FROM t a JOIN t b ON a.g = b.g AND a.class_id <> b.class_id GROUP BY ALL),
l AS (SELECT c.a, count(*) AS n_links FROM c JOIN n x ON x.class_id = c.a JOIN n y ON y.class_id = c.b WHERE c.k * 10 >= {tenths} * (x.n + y.n - c.k) GROUP BY c.a)
SELECT block_id, class_id, class_size, coalesce(n_links, 0) AS n_links FROM m LEFT JOIN l ON l.a = m.class_id
"""


SQL["p3_classes"] = _records_sql(3, 6, 40)
SQL["p3_records"] = _records_sql(5, 8, 5)
SQL["p7_found"] = r"""
WITH i AS (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM eval_items), d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents),
gi AS (SELECT DISTINCT item_id, array_to_string(w[k : k + 12], ' ') AS g FROM (SELECT item_id, w, unnest(range(1, len(w) - 11)) AS k FROM i WHERE len(w) >= 13)),
gd AS (SELECT DISTINCT doc_id, array_to_string(w[k : k + 12], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS k FROM d WHERE len(w) >= 13))
SELECT DISTINCT doc_id, item_id FROM gd JOIN gi USING (g)
"""
