"""Page geometry: blocks of text, tables and images of pages, merged in reading order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codexgrid.functions import blocks as B
from codexgrid.operators.ordered import Run, running

DOC = ("doc", "page")


def table_boxes(lines: DataFrame) -> DataFrame:
    """Per page with three horizontal and three vertical strokes or more (ends differing by under 2), the box around all: doc, page, bbox.

    ``lines`` has doc, page, x0, y0, x1, y1; boxes up to 30 by 20 points are none.
    """
    flat = F.abs(F.col("y1") - F.col("y0")) < 2
    steep = F.abs(F.col("x1") - F.col("x0")) < 2
    box = F.array(F.min(F.least("x0", "x1")), F.min(F.least("y0", "y1")), F.max(F.greatest("x0", "x1")), F.max(F.greatest("y0", "y1")))
    g = lines.filter(flat | steep).groupBy(*DOC).agg(F.sum(flat.cast("int")).alias("h"), F.sum((steep & ~flat).cast("int")).alias("v"), box.alias("bbox"))
    return sized(g.filter("h >= 3 and v >= 3").select(*DOC, "bbox"), 30, 20)


def sized(boxes: DataFrame, width: float, height: float) -> DataFrame:
    """Boxes wider and higher than given (tables 30 by 20, images 20 by 20)."""
    return boxes.filter((F.col("bbox")[2] - F.col("bbox")[0] > width) & (F.col("bbox")[3] - F.col("bbox")[1] > height))


def outside(items: DataFrame, media: DataFrame, margin: float) -> DataFrame:
    """Items (doc, page, bbox, ...) of whose page no medium overlaps them: images against tables with 4, text against media with 2."""
    m = media.select(F.col("doc").alias("_d"), F.col("page").alias("_p"), F.col("bbox").alias("_b"))
    return items.join(m, (F.col("doc") == F.col("_d")) & (F.col("page") == F.col("_p")) & B.overlaps(F.col("bbox"), F.col("_b"), margin), "left_anti")


#: Fixed value: what names a figure, table or equation.
CAPTION = r"(?i)(?:Figure|Fig\.?|Table|Tbl\.?|Equation|Eq\.?)\s*\d*\.?\d*"


def near_text(media: DataFrame, text: DataFrame, below: bool, band: float = 48.0, side: float = 10.0, limit: int = 200) -> DataFrame:
    """Media with ``near``: the caption in the band below, or the label in the band above.

    The blocks of text that lie in the band are read as one, from top to bottom.
    If it names a figure, table or equation anywhere, the caption is all of it
    (``limit`` characters) and the label the name with its number alone.
    """
    t = text.select(F.col("doc").alias("_d"), F.col("page").alias("_p"), F.col("bbox").alias("_b"), F.col("text").alias("_t"))
    b, m = F.col("_b"), F.col("bbox")
    inside = (b[0] >= m[0] - side) & (b[2] <= m[2] + side)
    place = ((b[1] >= m[3]) & (b[3] <= m[3] + band)) if below else ((b[3] <= m[1]) & (b[1] >= F.greatest(m[1] - band, F.lit(0.0))))
    hit = media.join(t, (F.col("doc") == F.col("_d")) & (F.col("page") == F.col("_p")) & inside & place & F.col("_t").isNotNull())
    lines = F.array_sort(F.collect_list(F.struct(b[1].alias("y"), b[0].alias("x"), F.col("_t").alias("t"))))  # of one page
    read = hit.groupBy("doc", "page", "bbox").agg(B.strip(F.array_join(F.transform(lines, lambda x: x["t"]), "\n")).alias("_r"))
    found = F.regexp_extract("_r", CAPTION, 0)
    near = F.when(found != "", F.substring("_r", 1, limit) if below else found)
    return media.join(read.select("doc", "page", "bbox", near.alias("near")), ["doc", "page", "bbox"], "left")


def reading_order(text: DataFrame, media: DataFrame) -> DataFrame:
    """Text and media of each document in order of page and top edge, text first on ties; ``ord`` from 1 within a page."""
    t = text.select("doc", "page", "bbox", F.lit(0).alias("kind_order"), "ordinal", F.col("text").alias("body"))
    m = media.select("doc", "page", "bbox", F.lit(1).alias("kind_order"), "ordinal", F.concat(F.lit("[[IMG:"), "uid", F.lit("]]")).alias("body"))
    w = Window.partitionBy("doc", "page").orderBy(F.col("bbox")[1], "kind_order", "ordinal")  # one page
    return t.unionByName(m).withColumn("ord", F.row_number().over(w))


def annex_marks(pages: DataFrame) -> DataFrame:
    """doc, page, annex of the pages on which the annex named at the top (null: none named) differs from the last named one."""
    d = running(pages.withColumn("pos", F.col("page")), {"_b": Run("last", F.col("annex"))}, doc=("doc",))
    return d.filter("annex is not null and (_b is null or _b <> annex)").select("doc", "page", "annex")


def marked_text(blocks: DataFrame, marks: DataFrame) -> DataFrame:
    """doc, page, text: the page's blocks joined by line breaks, an annex mark before where the annex changes."""
    p = blocks.groupBy("doc", "page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "body"))), lambda x: x["body"]), "\n").alias("_t"))
    d = p.join(marks, ["doc", "page"], "left")
    return d.select("doc", "page", F.when(F.col("annex").isNotNull(), F.concat(F.lit("[[ANNEX:"), F.col("annex").cast("string"), F.lit("]]\n"), F.col("_t"))).otherwise(F.col("_t")).alias("text"))


def page_annex(text: Column) -> Column:
    """The annex that the head of a page names: after the document's symbol line, the first line that is no page number or regulation line.

    A comma or the word "paragraph" in that line makes it text, not a head.
    """
    lines = F.filter(F.transform(F.split(B.text0(text), "\n"), B.strip), lambda x: x != "")
    symbol = r"^(?:E/|ECE/|ECE-TRANS-)"
    at = F.array_position(F.transform(lines, lambda x: x.rlike(symbol)), True)
    rest = F.slice(lines, at.cast("int") + 1, F.greatest(F.size(lines), F.lit(1)))
    kept = F.filter(rest, lambda x: ~x.rlike(r"(?i)^(?:page\s+)?\d+$") & ~x.rlike(r"(?i)^(?:UN\s+)?Regulation\s+No\.?\s*\d+$"))
    head = F.get(kept, F.lit(0))
    n = F.regexp_extract(head, r"(?i)^Annex\s+(\d+)", 1)
    return F.when((at > 0) & head.isNotNull() & (n != "") & ~head.rlike("(?i),|paragraph"), n.try_cast("int"))
