"""What pages and indexes show: progress, versions, selections, the page model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codexgrid.functions import blocks as B
from codexgrid.operators import glossary as G
from codexgrid.operators import noise, proposals, references, structure
from codexgrid.operators.ordered import DOC
from codexgrid.plans.materialize import written


def current(rows: DataFrame, *columns: str) -> DataFrame:
    """``block_id`` and the columns named (default: all) of rows given again once, as loaded last (ties: any, they are equal).

    Only the columns named are read and shuffled.
    """
    others = [c for c in (columns or rows.columns) if c != "block_id"]
    return rows.groupBy("block_id").agg(F.max_by(F.struct(*others), "loaded_at").alias("x")).select("block_id", *(F.col("x")[c].alias(c) for c in others))


def progress(rows: DataFrame) -> DataFrame:
    """Per regulation: paragraphs, translated ones and per cent (truncated)."""
    p = rows.filter(B.kind(F.col("type")) == "paragraph")
    done = F.count_if(F.col("status").isin("done", "translated"))
    return p.groupBy("regulation").agg(F.count("*").alias("total"), done.alias("translated")).withColumn("progress", B.progress(F.col("translated"), F.col("total")))


def latest_versions(versions: DataFrame, natural: bool = False) -> DataFrame:
    """Per regulation the latest version: by lower-cased name, or as people count (``natural``)."""
    key = B.natural_version(F.col("version")) if natural else F.lower("version")
    return versions.filter("version is not null and lower(version) <> 'diff'").groupBy("regulation").agg(F.max_by("version", key).alias("version"))


def index_rows(rows: DataFrame, versions: DataFrame) -> DataFrame:
    """The index: each regulation's latest version with its progress, in reading order of regulations."""
    v = latest_versions(versions)
    p = rows.join(v, ["regulation", "version"], "left_semi")
    return progress(p).join(v, "regulation").withColumn("rank", B.document_rank(F.col("regulation")))


def chapter_rows(rows: DataFrame, chapter: str, open_to: int = 3) -> DataFrame:
    """What selecting a chapter shows: first rows outside annexes at or below it; ``collapsed`` beyond level 3."""
    annex = F.coalesce("in_annex", F.lit(False)) if "in_annex" in rows.columns else F.col("annex_id").isNotNull()
    return rows.filter(B.under(F.col("number"), F.col("parent"), chapter) & F.col("first_occ") & ~annex).withColumn("collapsed", F.col("level") > open_to)


def annex_selection(rows: DataFrame, annex: int, open_to: int = 3) -> DataFrame:
    """What selecting an annex shows."""
    return rows.filter((F.col("annex") == annex) & F.col("first_occ_annex")).withColumn("collapsed", F.col("level") > open_to)


def with_children(rows: DataFrame) -> DataFrame:
    """Rows that have a row below them in their document."""
    c = rows.filter("parent is not null").select(*DOC, F.col("parent").alias("number")).distinct()
    return rows.filter("number <> ''").join(c, [*DOC, "number"], "left_semi")


def subtree(rows: DataFrame, number: str) -> DataFrame:
    """All rows below a number."""
    return rows.filter(F.startswith(B.text0(F.col("number")), F.lit(number + ".")))


def _annotated(d: DataFrame, terms: DataFrame, text: str, term: str, ignore_case: bool, name: str) -> DataFrame:
    """``d`` with ``name``: the column ``text`` as escaped HTML with its glossary terms marked."""
    found = G.matches(d.filter("type is null or type <> 'image'"), terms, text, term, ignore_case, keys=(*DOC, "pos"))
    spans = found.groupBy(*DOC, "pos").agg(F.array_sort(F.collect_list(F.struct("start", "end", "term"))).alias("_spans"))
    shown = B.text0(F.col(text))
    marked = F.when(F.col("_spans").isNull(), B.escape_html(shown)).otherwise(G.annotated(shown, F.col("_spans")))
    return d.join(spans, [*DOC, "pos"], "left").withColumn(name, B.inline_list(marked)).drop("_spans")


def page_model(rows: DataFrame, pending: DataFrame, glossary: DataFrame, versions: DataFrame | None = None) -> DataFrame:
    """The rows of pages, annotated in the order that later steps need: contents, noise, annexes, parts, references, first rows, terms.

    Inserted additions are never noise. ``versions`` gives titles of annexes
    (annex_titles). Also the dividers between annexes and chapters, the titles of
    annexes and, on the first row of a chapter, the chapters passed over before
    it. One row a block; the sink orders by document and pos.
    """
    d = written(proposals.inserted(proposals.attached(rows, pending), pending), "page-rows")
    chapters = written(structure.chapters(d), "page-chapters")
    last = structure.last_chapters(d, chapters)
    annexes = written(structure.annex_tree(d, versions), "page-annexes")
    contents = written(structure.contents_rows(d, versions), "page-contents")
    d = noise.marked(d).join(contents.withColumn("_contents", F.lit(True)), [*DOC, "pos"], "left")
    d = d.withColumn("nav_hidden", (F.col("nav_hidden") | F.coalesce("_contents", F.lit(False))) & ~F.col("proposal_only")).drop("_contents")
    d = written(structure.in_annex(written(d, "page-noise")), "page-annex")
    d = written(structure.annex_ids(d, last), "page-ids")
    d = written(structure.annex_parts(written(structure.annex_page_noise(d), "page-footnotes")), "page-parts")
    d = written(structure.first_occurrence(d), "page-first")
    gaps = structure.chapter_gaps(d, chapters.filter(~F.col("toc_row"))).select(*DOC, "pos", F.col("missing").alias("gap_chapters"))
    marks = structure.dividers(d).select(*DOC, "pos", "divider")
    titles = annexes.select(*DOC, "annex", F.col("title").alias("annex_title"), F.col("title_ja").alias("annex_title_ja"))
    refs = references.resolved(d).groupBy(*DOC, "pos").agg(F.array_sort(F.collect_list(F.struct("ref_no", "number", "annex", "target_uid", "target_summary"))).alias("refs"))
    d = d.join(gaps, [*DOC, "pos"], "left").join(marks, [*DOC, "pos"], "left").join(titles, [*DOC, "annex"], "left")
    d = written(d.join(refs, [*DOC, "pos"], "left"), "page-refs")
    d = _annotated(d, G.english_terms(glossary), "text", "term", True, "text_annotated")
    d = _annotated(d, G.japanese_terms(glossary), "translation", "ja", False, "translation_annotated")
    told = (B.kind(F.col("type")) != "image") & (B.text0(F.col("translation")) != "")
    return d.withColumn("translation_annotated", F.when(told, F.col("translation_annotated"))).withColumn("summary_ja_short", B.short_summary(B.text0(F.col("summary_ja"))))
