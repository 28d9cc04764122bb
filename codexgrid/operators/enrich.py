"""Batch enrichment of pending rows through a callable (a translator, a summariser)."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codexgrid.functions import blocks as B
from codexgrid.operators.ordered import DOC, Run, running

BODY, SUMMARY, HEADINGS = 10, 10, 200  # rows a call


def body_targets(rows: DataFrame, prefix: str | None = None, limit: int = 0) -> DataFrame:
    """Untranslated paragraphs (of a chapter prefix), in order, ``limit`` of them (0: all)."""
    d = rows.filter((B.kind(F.col("type")) == "paragraph") & (F.col("status") == "untranslated"))
    d = d if prefix is None else d.filter(B.at_prefix(F.col("number"), prefix))
    return d.orderBy(*DOC, "pos").limit(limit) if limit else d


def summary_targets(rows: DataFrame, prefix: str | None = None, limit: int = 0) -> DataFrame:
    """Translated paragraphs with text, in order."""
    d = rows.filter((B.kind(F.col("type")) == "paragraph") & F.col("status").isin("done", "translated") & (B.strip(B.text0(F.col("text"))) != ""))
    d = d if prefix is None else d.filter(B.at_prefix(F.col("number"), prefix))
    return d.orderBy(*DOC, "pos").limit(limit) if limit else d


def heading_targets(rows: DataFrame, overwrite: bool = False) -> DataFrame:
    """Paragraphs with a title and, unless ``overwrite``, no Japanese title."""
    d = rows.filter((B.kind(F.col("type")) == "paragraph") & (B.text0(F.col("title")) != ""))
    return d if overwrite else d.filter(B.text0(F.col("title_ja")) == "")


def batches(targets: DataFrame, size: int) -> DataFrame:
    """``batch_no`` from 0 by document in order of position."""
    d = running(targets, {"_n": Run("sum", F.lit(1))})
    return d.withColumn("batch_no", F.floor(F.col("_n") / size).cast("int")).drop("_n")


def user_prompt(number: Column, title: Column, text: Column) -> Column:
    return F.format_string("段落番号: %s\nタイトル: %s\n本文:\n%s", B.text0(number), B.text0(title), B.text0(text))


def system_prompt(glossary_block: Column) -> Column:
    """What every call says first: the task and the terms to use."""
    return F.format_string("あなたは車両法規の専門翻訳者です。次の用語集に従って翻訳してください。\n\n%s", B.text0(glossary_block))


def preview(targets: DataFrame, n: int = 20) -> DataFrame:
    """What a run would take: the first ``n`` targets in order, each with ``n_more``, the number of the others."""
    more = targets.agg(F.greatest(F.count("*") - n, F.lit(0)).alias("n_more"))
    return targets.orderBy(*DOC, "pos").limit(n).join(F.broadcast(more))  # one row


def reply_json(reply: Column, schema: str) -> Column:
    """The object in a reply, whatever fence or words surround it, its strings stripped; null where there is none.

    ``schema`` names its fields, all strings or numbers.
    """
    body = F.regexp_extract(B.text0(reply), r"(?s)\{.*\}", 0)
    got = F.from_json(body, schema)
    fields = [f.strip().split()[:2] for f in schema.split(",")]
    return F.when((body != "") & got.isNotNull(), F.struct(*[(B.strip(got[n]) if kind.lower() == "string" else got[n]).alias(n) for n, kind in fields]))


class Throttled(Exception):
    """Raised by a callable to be asked again after ``wait`` seconds."""

    def __init__(self, wait: float = 60.0) -> None:
        super().__init__(f"wait {wait} s")
        self.wait = wait


def patient(call: Callable[[list[dict]], list[dict]], retries: int = 3, pause: Callable[[float], None] = time.sleep) -> Callable[[list[dict]], list[dict]]:
    """``call`` repeated up to ``retries`` times when throttled; other errors pass."""

    def asked(rows: list[dict]) -> list[dict]:
        for k in range(retries + 1):
            try:
                return call(rows)
            except Throttled as e:
                if k == retries:
                    raise
                pause(e.wait + 2.0)
        raise AssertionError

    return asked


def enriched(targets: DataFrame, call: Callable[[list[dict]], list[dict]], size: int, fields: tuple[str, ...]) -> DataFrame:
    """regulation, version, pos, the fields and result (done or error): the answers of ``call`` to the batches of each document, by position.

    A batch that fails is an error of its rows; the others go on. Answers are
    keyed by position, so equal numbers or identities don't share one. The
    callable gets at most ``size`` rows of one document, in order (dicts of pos,
    number, title, text), and returns as many dicts in the same order.
    """
    d = batches(targets.select(*DOC, "pos", "number", "title", "text"), size)
    schema = "regulation string, version string, pos int, " + ", ".join(f"{f} string" for f in fields) + ", result string"

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = pdf.sort_values("pos").to_dict("records")
        try:
            got = call([{k: r[k] for k in ("pos", "number", "title", "text")} for r in rows])
            ok = len(got) == len(rows)
        except Exception:  # a failed call is recorded, not fatal
            got, ok = [], False
        out = []
        for k, r in enumerate(rows):
            values = [(str(got[k][f]).strip() if ok and got[k].get(f) else None) for f in fields]
            out.append((r["regulation"], r["version"], r["pos"], *values, "done" if ok and any(v is not None for v in values) else "error"))
        return pd.DataFrame(out, columns=["regulation", "version", "pos", *fields, "result"])

    return d.groupBy(*DOC, "batch_no").applyInPandas(run, schema)


def written_back(rows: DataFrame, results: DataFrame, fields: tuple[str, ...], status: bool = True) -> DataFrame:
    """``rows`` with the fields of ``results`` where they were done; ``status`` follows the result unless told not to."""
    r = results.select(*DOC, "pos", *(F.col(f).alias(f"_{f}") for f in fields), F.col("result").alias("_result"))
    d = rows.join(r, [*DOC, "pos"], "left")
    done = F.col("_result") == "done"
    d = d.withColumns({f: F.when(done, F.col(f"_{f}")).otherwise(F.col(f)) for f in fields})
    if status:
        d = d.withColumn("status", F.coalesce("_result", "status"))
    return d.drop("_result", *(f"_{f}" for f in fields))


def mapped(rows: DataFrame, translations: DataFrame, first: int | None = None, last: int | None = None) -> DataFrame:
    """``rows`` with title_ja and translation from a table by number, within positions [first, last); their status becomes translated."""
    t = translations.groupBy("number").agg(F.min(F.struct(F.col("title_ja").alias("tj"), F.col("translation").alias("tr"))).alias("_t"))
    d = rows.join(t, "number", "left")
    hit = F.col("_t").isNotNull()
    for bound, ok in ((first, F.col("pos") >= (first or 0)), (last, F.col("pos") < (last or 0))):
        hit = hit & ok if bound is not None else hit
    return d.withColumn("title_ja", F.when(hit, F.coalesce("_t.tj", "title_ja")).otherwise(F.col("title_ja"))).withColumn("translation", F.when(hit, F.coalesce("_t.tr", "translation")).otherwise(F.col("translation"))).withColumn(
        "status", F.when(hit, "translated").otherwise(F.col("status"))
    ).drop("_t")


def counters(results: DataFrame) -> DataFrame:
    """processed, done, errors of a run."""
    return results.agg(F.count("*").alias("processed"), F.count_if(F.col("result") == "done").alias("done"), F.count_if(F.col("result") == "error").alias("errors"))
