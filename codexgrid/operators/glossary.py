"""Glossary terms in texts."""

from __future__ import annotations

import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codexgrid.functions import blocks as B


def english_terms(glossary: DataFrame) -> DataFrame:
    """regulation, term, definition, paragraph_ref: of a term given twice the greatest entry holds (rows have no order of their own)."""
    g = glossary.filter("term is not null and term <> ''")
    note = F.when(B.text0(F.col("description")) != "", F.col("description")).otherwise(B.text0(F.col("ja")))
    return g.groupBy("regulation", "term").agg(F.max(F.struct(note.alias("definition"), B.text0(F.col("paragraph_ref")).alias("paragraph_ref"))).alias("x")).select("regulation", "term", "x.*")


def japanese_terms(glossary: DataFrame) -> DataFrame:
    """regulation, ja, term, definition, paragraph_ref: of a Japanese term given twice the least entry holds."""
    g = glossary.withColumn("ja", B.strip(F.col("ja"))).filter("ja <> ''")
    note = F.when(B.text0(F.col("description")) != "", F.col("description")).otherwise(F.col("ja"))
    return g.groupBy("regulation", "ja").agg(F.min(F.struct(B.text0(F.col("term")).alias("term"), note.alias("definition"), B.text0(F.col("paragraph_ref")).alias("paragraph_ref"))).alias("x")).select("regulation", "ja", "x.*")


@lru_cache(maxsize=256)
def _patterns(terms: tuple[str, ...], ignore_case: bool, whole_words: bool) -> list[tuple[str, re.Pattern]]:
    """The terms, longest first, with their patterns; compiled once for each list."""
    edge = r"\b" if whole_words else ""
    return [(t, re.compile(edge + re.escape(t) + edge, re.I if ignore_case else 0)) for t in sorted(set(terms), key=lambda t: (-len(t), t)) if t]


def spans(text: str, terms: list[str], ignore_case: bool, whole_words: bool = False) -> list[tuple[int, int, str]]:
    """(start, end, term) of the occurrences, the longest term first, none overlapping, in order of place."""
    free, taken = bytearray(len(text)), []
    for term, pattern in _patterns(tuple(terms), ignore_case, whole_words):
        for m in pattern.finditer(text):
            a, b = m.span()
            if not any(free[a:b]):
                free[a:b] = b"\1" * (b - a)
                taken.append((a, b, term))
    return sorted(taken)


def matches(rows: DataFrame, terms: DataFrame, text: str = "text", term: str = "term", ignore_case: bool = True, whole_words: bool = False, keys: tuple[str, ...] = ("block_id",)) -> DataFrame:
    """(keys, start, end, term) of every occurrence in ``text`` of the row's regulation's terms (start from 0, end exclusive).

    The terms of a regulation meet its rows in a join; nothing is broadcast.
    """

    @F.pandas_udf("array<struct<start int, end int, term string>>")
    def find(t: pd.Series, w: pd.Series) -> pd.Series:
        return pd.Series([[{"start": a, "end": b, "term": x} for a, b, x in spans(s or "", list(ws), ignore_case, whole_words)] for s, ws in zip(t, w)])

    lists = terms.groupBy("regulation").agg(F.array_sort(F.collect_set(term)).alias("_terms"))
    d = rows.filter(F.col(text).isNotNull()).select(*keys, "regulation", text).join(lists, "regulation")
    return d.select(*keys, F.explode(find(text, "_terms")).alias("m")).select(*keys, "m.start", "m.end", F.col("m.term").alias("term")).distinct()


def annotated(text: Column, found: Column) -> Column:
    """``text`` with each span of ``found`` (array of start, end, term, in order) in a marked, escaped element."""
    piece = lambda acc, x: F.struct(
        F.concat(acc["out"], B.escape_html(F.substring(text, acc["at"] + 1, x["start"] - acc["at"])), F.lit('<span class="term" data-term="'), B.escape_html(x["term"]), F.lit('">'), B.escape_html(F.substring(text, x["start"] + 1, x["end"] - x["start"])), F.lit("</span>")).alias("out"),
        x["end"].alias("at"),
    )
    return F.aggregate(found, F.struct(F.lit("").alias("out"), F.lit(0).alias("at")), piece, lambda acc: F.concat(acc["out"], B.escape_html(F.substring(text, acc["at"] + 1, F.length(text)))))


def prompt_table(glossary: DataFrame) -> DataFrame:
    """regulation, glossary_block: a table of terms for a prompt, one line a term in order of the term."""
    alias = F.when(F.size(F.coalesce("aliases", F.array())) > 0, F.concat(F.lit("（別称: "), F.array_join("aliases", ", "), F.lit("）"))).otherwise(F.lit(""))
    line = F.concat(F.lit("| "), B.text0(F.col("term")), F.lit(" | "), B.text0(F.col("ja")), F.lit(" | "), B.text0(F.col("description")), alias, F.lit(" |"))
    return glossary.groupBy("regulation").agg(F.array_join(F.transform(F.array_sort(F.collect_set(F.struct(B.text0(F.col("term")).alias("t"), line.alias("l")))), lambda x: x["l"]), "\n").alias("glossary_block"))
