"""JSON documents in and out: one folder a version, the schema explicit, absent files empty."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK = (
    "uid string, type string, number string, title string, text string, level int, parent string, status string, translation string, summary_ja string, title_ja string, "
    "modified boolean, justification string, prev_uid string, text_old string, annex_id int, page int, bbox array<double>, src string, label string, caption string"
)
FIELDS = [x.split()[0] for x in BLOCK.split(", ")]
DOCUMENT = f"regulation string, version string, source_date string, title string, annex_titles map<string, struct<title string, title_ja string>>, paragraphs array<struct<{BLOCK}>>"
GLOSSARY = ("regulation string, terms array<struct<term string, ja string, description string, definition_en string, paragraph_ref string, aliases array<string>>>")
PROPOSALS = (
    "regulation string, proposals array<struct<id string, type string, target_uid string, anchor_uid string, number string, title string, text_new string, justification string, source_date string, source_label string>>"
)


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


def _json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).json(path) if _exists(spark, path) else spark.createDataFrame([], schema)


def documents(spark: SparkSession, path: str) -> DataFrame:
    """The documents at a path or pattern (nested form)."""
    return _json(spark, path, DOCUMENT)


def blocks(docs: DataFrame) -> DataFrame:
    """One row a block, with regulation, version and pos; a block without type is a paragraph."""
    d = docs.select("regulation", "version", F.posexplode("paragraphs").alias("pos", "_b"))
    return d.select("regulation", "version", "pos", *(F.col("_b")[f].alias(f) for f in FIELDS)).withColumn("type", F.coalesce("type", F.lit("paragraph")))


def glossary(spark: SparkSession, path: str) -> DataFrame:
    """Terms of all glossaries at a path; none where it doesn't exist."""
    return _json(spark, path, GLOSSARY).select("regulation", F.explode("terms").alias("t")).select("regulation", "t.*")


def proposals(spark: SparkSession, path: str) -> DataFrame:
    return _json(spark, path, PROPOSALS).select("regulation", F.explode("proposals").alias("p")).select("regulation", "p.*")


def catalog(spark: SparkSession, path: str) -> DataFrame:
    """regulation, version of the folders <regulation>/<version>/structured.json below a path."""
    if not _exists(spark, f"{path}/*/*/structured.json"):
        return spark.createDataFrame([], "regulation string, version string")
    f = spark.read.format("binaryFile").load(f"{path}/*/*/structured.json").select("path")
    m = r".*/([^/]+)/([^/]+)/structured\.json$"
    return f.select(F.regexp_extract("path", m, 1).alias("regulation"), F.regexp_extract("path", m, 2).alias("version")).filter("lower(version) <> 'diff'")


def nested(rows: DataFrame, versions: DataFrame) -> DataFrame:
    """Documents of their blocks, in order of pos (a document is one value: the form of the JSON files)."""
    have = [f for f in FIELDS if f in rows.columns]
    g = rows.groupBy("regulation", "version").agg(F.array_sort(F.collect_list(F.struct("pos", *have))).alias("_b"))
    return versions.join(g, ["regulation", "version"]).withColumn("paragraphs", F.transform("_b", lambda b: F.struct(*[b[c].alias(c) for c in have]))).drop("_b")


def published(rows: DataFrame, regulation: str) -> DataFrame:
    """The rows of one regulation as they were stored, for publication beside its page: none of the columns that pages add."""
    added = ("annex", "in_annex", "nav_hidden", "nav_only_hidden", "first_occ", "first_occ_annex", "refs", "divider", "gap_chapters", "text_annotated", "translation_annotated", "summary_ja_short", "display_number", "proposals", "proposal_only")
    return rows.filter(F.col("regulation") == regulation).drop(*added, *(c for c in rows.columns if c.startswith("part_")), "multiple_parts")


def write_json(docs: DataFrame, path: str) -> None:
    """Overwrite ``path`` with one JSON line a document, partitioned by regulation and version. Don't write to a path being read."""
    docs.withColumns({"_r": F.col("regulation"), "_v": F.col("version")}).write.mode("overwrite").partitionBy("_r", "_v").json(path)


def write_blocks(rows: DataFrame, path: str) -> None:
    """Blocks as Parquet, partitioned by regulation; only the partitions written are replaced."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("regulation").parquet(path)
