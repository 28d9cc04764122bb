"""References between paragraphs: extraction from text and resolution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codexgrid.functions import blocks as B
from codexgrid.operators.ordered import DOC

# How a reference to an annex, to the regulation itself and to a plain list of numbers is written.
OF_ANNEX = r"(?i)\bparagraphs?\s+([\d.]+?\.?)\s+of\s+(?:Part\s+\w+\s+of\s+)?Annex\s+(\d+)(?:\s+to\s+this\s+Regulation)?"
OF_THIS = r"(?i)\bparagraphs?\s+([\d.]+?\.?)\s+of\s+this\s+Regulation"
PLAIN = r"(?i)\bparagraphs?\s+\d+(?:\.\d+)+\.?(?:(?:\s*,\s*(?:and|or|to)?\s+|\s+(?:and|or|to)\s+)\d+(?:\.\d+)+\.?)*"


def _bare(x: Column) -> Column:
    return F.regexp_replace(x, r"\.+$", "")


def extracted(text: Column, own_annex: Column) -> Column:
    """array<struct<number, annex>>: numbers with the annex named, null for the regulation, the row's own annex where none is named.

    Named references come first; numbers inside them aren't counted again; each pair once, in order.
    """
    t = B.text0(text)
    pair = lambda n, a: F.struct(_bare(n).alias("number"), a.cast("int").alias("annex"))
    named = F.zip_with(F.regexp_extract_all(t, F.lit(OF_ANNEX), F.lit(1)), F.regexp_extract_all(t, F.lit(OF_ANNEX), F.lit(2)), lambda n, a: pair(n, a))
    this = F.transform(F.regexp_extract_all(t, F.lit(OF_THIS), F.lit(1)), lambda n: pair(n, F.lit(None)))
    rest = F.regexp_replace(F.regexp_replace(t, OF_ANNEX, "\x00"), OF_THIS, "\x00")
    lists = F.regexp_extract_all(rest, F.lit(PLAIN), F.lit(0))
    plain = F.transform(F.flatten(F.transform(lists, lambda m: F.regexp_extract_all(m, F.lit(r"\d+(?:\.\d+)+"), F.lit(0)))), lambda n: pair(n, own_annex))
    return F.array_distinct(F.filter(F.concat(named, this, plain), lambda x: x["number"] != ""))


def edges(rows: DataFrame) -> DataFrame:
    """regulation, version, pos, ref_no, number, annex: the references of each visible row; needs ``annex`` or ``annex_id``."""
    annex = F.col("annex") if "annex" in rows.columns else F.col("annex_id")
    hidden = F.coalesce("nav_hidden", F.lit(False)) if "nav_hidden" in rows.columns else F.lit(False)
    d = rows.filter((B.kind(F.col("type")) != "image") & ~hidden)
    return d.select(*DOC, "pos", F.posexplode(extracted(F.col("text"), annex)).alias("ref_no", "_r")).select(*DOC, "pos", "ref_no", "_r.number", "_r.annex")


def resolved(rows: DataFrame) -> DataFrame:
    """The edges whose target exists, is visible and has a summary: with target_uid and target_summary.

    A number's target is its first row, but a visible one goes before a hidden one.
    """
    annex = F.col("annex") if "annex" in rows.columns else F.col("annex_id")
    hidden = F.coalesce("nav_hidden", F.lit(False)) if "nav_hidden" in rows.columns else F.lit(False)
    named = rows.filter((B.kind(F.col("type")) != "image") & (B.text0(F.col("number")) != ""))
    best = named.groupBy(*DOC, "number", annex.alias("annex")).agg(F.min_by(F.struct(hidden.alias("hidden"), F.col("uid"), B.strip(B.text0(F.col("summary_ja"))).alias("summary")), F.struct(hidden.cast("int").alias("h"), F.col("pos"))).alias("t"))
    best = best.filter("not t.hidden and t.summary <> ''").select(F.col("regulation").alias("tr"), F.col("version").alias("tv"), F.col("number").alias("tn"), F.col("annex").alias("ta"), F.col("t.uid").alias("target_uid"), F.col("t.summary").alias("target_summary"))
    on = (F.col("regulation") == F.col("tr")) & (F.col("version") == F.col("tv")) & (F.col("number") == F.col("tn")) & F.col("annex").eqNullSafe(F.col("ta"))
    return edges(rows).join(best, on).drop("tr", "tv", "tn", "ta")
