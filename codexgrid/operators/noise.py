"""Rows that are no content: leaders, page numbers, repeated footnotes, cells."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from codexgrid.functions import blocks as B
from codexgrid.operators.ordered import DOC
from codexgrid.operators.similarity import near_duplicates

NEAR = 0.9


def _paragraphs(rows: DataFrame) -> DataFrame:
    return rows.filter(B.kind(F.col("type")) != "image")


def _real(rows: DataFrame) -> DataFrame:
    """Paragraphs that aren't inserted additions."""
    p = _paragraphs(rows)
    return p.filter(~F.coalesce("proposal_only", F.lit(False))) if "proposal_only" in rows.columns else p


def toc_duplicates(rows: DataFrame) -> DataFrame:
    """(regulation, version, uid) of plainly numbered rows of level 1 with a dotted leader whose annex and number also have a clean title."""
    p = _real(rows).withColumn("_n", B.strip(B.text0(F.col("number")))).filter((F.coalesce("level", F.lit(1)) == 1) & F.col("_n").rlike(r"^\d{1,2}$"))
    dotted = F.contains(B.text0(F.col("title")), F.lit("......"))
    g = p.groupBy(*DOC, F.coalesce("annex_id", F.lit(-1)).alias("_a"), "_n").agg(F.count("*").alias("n"), F.max(~dotted).alias("clean"), F.collect_set(F.when(dotted | B.toc_overflow(F.col("text")), F.col("uid"))).alias("uids"))
    return g.filter("n >= 2 and clean").select(*DOC, F.explode("uids").alias("uid")).distinct()


def page_number_duplicates(rows: DataFrame) -> DataFrame:
    """(regulation, version, uid) of rows whose number is a page number and whose text repeats under the same title."""
    p = _paragraphs(rows).filter(B.strip(B.text0(F.col("number"))).rlike(r"^\d{3,}$"))
    k = p.select(*DOC, F.coalesce("annex_id", F.lit(-1)).alias("_a"), B.strip(B.text0(F.col("title"))).alias("_t"), F.col("pos").cast("long").alias("id"), "text")
    near = near_duplicates(k, [*DOC, "_a", "_t"], NEAR)
    return p.join(near.select(*DOC, F.col("id").cast("int").alias("pos")), [*DOC, "pos"]).select(*DOC, "uid").distinct()


def repeated_footnotes(rows: DataFrame) -> DataFrame:
    """(regulation, version, pos) of plainly numbered rows of level 1 that repeat nearly alike under one title, or are boiler-plate."""
    p = _real(rows).filter((F.coalesce("level", F.lit(1)) == 1) & B.text0(F.col("number")).rlike(r"^\d{1,2}$"))
    k = p.select(*DOC, F.coalesce("annex_id", F.lit(-1)).alias("_a"), B.text0(F.col("title")).alias("_t"), F.col("pos").cast("long").alias("id"), "text")
    near = near_duplicates(k, [*DOC, "_a", "_t"], NEAR).select(*DOC, F.col("id").cast("int").alias("pos"))
    return near.unionByName(p.filter(B.noise_title(F.col("title"))).select(*DOC, "pos")).distinct()


def marked(rows: DataFrame) -> DataFrame:
    """``rows`` with ``nav_hidden``: page headers, table-of-contents lines, page numbers taken for numbers, footnotes, cells."""
    flag = lambda d, name: d.withColumn(name, F.lit(True))
    d = rows.join(flag(toc_duplicates(rows), "_toc"), [*DOC, "uid"], "left").join(flag(page_number_duplicates(rows), "_page"), [*DOC, "uid"], "left").join(flag(repeated_footnotes(rows), "_foot"), [*DOC, "pos"], "left")
    title, text = B.strip(B.text0(F.col("title"))), B.strip(B.text0(F.col("text")))
    on = lambda c: F.coalesce(c, F.lit(False))
    noise = (
        F.when(text.rlike("^(?:E/)?ECE/") | title.rlike("^(?:E/)?ECE/"), True)
        .when(B.has_leader(title, text), on("_toc") | (~F.contains(title, F.lit("......")) & B.toc_overflow(text)))
        .when(B.strip(B.text0(F.col("number"))).rlike(r"^\d{3,}$"), on("_page"))
        .otherwise(False)
    )
    hidden = (B.kind(F.col("type")) != "image") & (noise | on("_foot") | B.table_cell(F.col("title")))
    return d.withColumn("nav_hidden", hidden).drop("_toc", "_page", "_foot")


def media_conflicts(rows: DataFrame, margin: float = 4.0) -> DataFrame:
    """(regulation, version, pos) of figures that overlap a table of their page, which holds them."""
    image = rows.filter((F.col("type") == "image") & F.col("bbox").isNotNull() & F.col("page").isNotNull())
    t = image.filter(F.col("label").startswith("Table")).select(*DOC, "page", F.col("bbox").alias("_t"))
    f = image.filter(~F.coalesce(F.col("label").startswith("Table"), F.lit(False)))
    return f.join(t, [*DOC, "page"]).filter(B.overlaps(F.col("bbox"), F.col("_t"), margin)).select(*DOC, "pos").distinct()


def media_labels(rows: DataFrame) -> DataFrame:
    """Images with ``shown_label``: their own, else their caption, else a running "Figure n" or "Table n" of the document."""
    kind = F.when(F.col("label").startswith("Table"), "Table").otherwise("Figure")
    d = rows.filter("type = 'image'").withColumn("_kind", kind)
    w = Window.partitionBy(*DOC, "_kind").orderBy("page", F.col("bbox")[1], "pos")  # the images of a document, not its rows
    own = F.when(B.text0(F.col("label")) != "", F.col("label"))
    return d.withColumn("shown_label", F.coalesce(own, F.col("caption"), F.concat_ws(" ", "_kind", F.row_number().over(w).cast("string")))).drop("_kind")
