"""HTML pages from page models and reports, one value a document."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codexgrid.functions import blocks as B


def regulation_pages(model: DataFrame) -> DataFrame:
    """regulation, version, html: the visible rows in order, each with number, title, annotated text and the first sentence of its summary."""
    head = F.concat(F.lit("<h"), F.least(F.coalesce("level", F.lit(1)) + 1, F.lit(6)).cast("string"), F.lit(' id="'), B.escape_html(B.text0(F.col("uid"))), F.lit('">'), B.escape_html(F.concat_ws(" ", "display_number", "title")), F.lit("</h>"))
    image = F.concat(F.lit('<figure><img src="'), B.escape_html(B.text0(F.col("src"))), F.lit('"><figcaption>'), B.escape_html(F.coalesce("label", "caption", F.lit(""))), F.lit("</figcaption></figure>"))
    body = F.concat(head, F.lit("<p>"), F.col("text_annotated"), F.lit("</p><p>"), B.escape_html(B.text0(F.col("summary_ja_short"))), F.lit("</p>"))
    row = F.when(B.kind(F.col("type")) == "image", image).otherwise(body)
    g = model.filter(~F.coalesce("nav_hidden", F.lit(False))).groupBy("regulation", "version").agg(F.array_sort(F.collect_list(F.struct("pos", row.alias("h")))).alias("_h"))
    return g.select("regulation", "version", F.array_join(F.transform("_h", lambda x: x["h"]), "\n").alias("html"))


def diff_pages(report: DataFrame, keys: list[str]) -> DataFrame:
    """keys, html: the changes of a report in order, old and new text beside each other, counts under lower-case names."""
    one = lambda c: F.concat(F.lit("<tr><td>"), F.lower(c["type"]), F.lit("</td><td>"), B.escape_html(B.text0(c["number"])), F.lit("</td><td>"), B.escape_html(B.text0(c["text_old"])), F.lit("</td><td>"), B.escape_html(B.text0(c["text_new"])), F.lit("</td></tr>"))
    counts = F.array_join(F.transform(F.map_entries("summary"), lambda e: F.concat(F.lower(e["key"]), F.lit(": "), e["value"].cast("string"))), ", ")
    return report.select(*keys, F.concat(F.lit("<p>"), counts, F.lit("</p><table>"), F.array_join(F.transform(F.coalesce("changes", F.array()), one), "\n"), F.lit("</table>")).alias("html"))


def index_page(rows: DataFrame) -> DataFrame:
    """html: the index of regulations with their progress, one line each; one value, so meant for some ten thousand regulations at most."""
    line = F.concat(F.lit("<li>"), B.escape_html(F.col("regulation")), F.lit(" "), B.escape_html(B.text0(F.col("version"))), F.lit(" "), F.col("translated").cast("string"), F.lit("/"), F.col("total").cast("string"), F.lit(" "), F.col("progress").cast("string"), F.lit(" %</li>"))
    return rows.groupBy().agg(F.array_sort(F.collect_list(F.struct("rank", line.alias("l")))).alias("_l")).select(F.concat(F.lit("<ul>"), F.array_join(F.transform("_l", lambda x: x["l"]), "\n"), F.lit("</ul>")).alias("html"))
