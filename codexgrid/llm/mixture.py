"""Mixing sources to target weights (problem 8): weighted sampling to token budgets.

Within a source every text has an Efraimidis-Spirakis key -ln(u)/w, u from a
seeded hash of the text and w its quality weight; the least keys come first.
Whole epochs of a source come first; the rest of its budget takes the texts in
order of their keys, each if its tokens still fit. The prefix sums run in key
ranges of about ``TEXTS_PER_RANGE`` texts, cut where the keys really lie: token
totals of ranges are summed first, so no window holds more than one range of one
source.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codexgrid.llm import tokens
from codexgrid.plans.materialize import written

TEXTS_PER_RANGE = 20_000
BINS = 64  # of a doubling of the key; a source has some four thousand at most


def quality(text: str = "text"):
    """A weight between 0.1 and 1: shares of letters, of words of usual length and of closed lines."""
    n = F.greatest(F.length(text), F.lit(1))
    letters = F.length(F.regexp_replace(text, r"[^\p{L}\s]", "")) / n
    closed = F.when(F.col(text).rlike(r"[.!?。]\s*$"), 1.0).otherwise(0.5)
    size = F.least(F.lit(1.0), F.length(text) / 200.0)
    return F.greatest(F.lit(0.1), F.least(F.lit(1.0), letters * closed * (0.5 + 0.5 * size)))


def _sized(docs: DataFrame, listed: DataFrame, seed: int, vocabulary: str) -> DataFrame:
    @F.pandas_udf(T.LongType())
    def size(it: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = tokens.encoding(vocabulary)[0]
        for s in it:
            yield pd.Series([len(enc.encode_ordinary(t)) for t in s], dtype="int64")

    d = docs.filter(F.col("text").isNotNull() & (F.col("text") != "") & F.col("source").isNotNull()).join(listed.select("source"), "source", "left_semi")
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), "text"), 11) + 0.5) / float(1 << 53)
    d = d.select("doc_id", "source", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(7), "text").alias("h2"), (-F.log(u) / quality()).alias("key"), size("text").alias("n_tokens"))
    # a text belongs to one source and one id, however often it is stored
    return d.groupBy("h1", "h2").agg(F.min(F.struct("source", "doc_id", "key", "n_tokens")).alias("x")).select("x.source", "x.doc_id", "x.key", "x.n_tokens")


def _plan(docs: DataFrame, targets: DataFrame, total: float | None, seed: int, vocabulary: str) -> tuple[DataFrame, DataFrame]:
    t = targets.filter(F.col("source").isNotNull() & (F.col("target_share") > 0)).groupBy("source").agg(F.max("target_share").alias("target_share"), F.greatest(F.max(F.coalesce("max_repeat", F.lit(1))), F.lit(0)).alias("max_repeat"))
    sized = written(_sized(docs, t, seed, vocabulary), "mixture-sizes")
    have = sized.groupBy("source").agg(F.sum("n_tokens").alias("available"), F.count("*").alias("n_available"))
    b = t.join(have, "source", "left").na.fill(0, ["available", "n_available"])
    everywhere = Window.partitionBy(F.lit(1))  # rows of the target list only
    can = F.col("available") * F.col("max_repeat")
    b = b.withColumn("share", F.when(can > 0, F.col("target_share"))).withColumn("share", F.col("share") / F.sum("share").over(everywhere))
    whole = F.min(can / F.col("share")).over(everywhere) if total is None else F.lit(float(total))
    b = b.withColumn("budget", F.least(F.floor(F.col("share") * whole + 1e-6), can.cast("long"))).na.fill(0, ["budget"])
    b = b.withColumn("epochs", F.when(F.col("available") > 0, F.floor(F.col("budget") / F.col("available"))).otherwise(0).cast("long"))
    b = b.withColumn("rest", F.when(F.col("epochs") >= F.col("max_repeat"), 0).otherwise(F.col("budget") - F.col("epochs") * F.col("available")).cast("long"))
    return sized, b


def mixture(docs: DataFrame, targets: DataFrame, total: float | None = None, seed: int = 11, vocabulary: str = tokens.VOCABULARY) -> DataFrame:
    """The texts of the mixture: doc_id, source, n_tokens, uses (at least 1).

    ``total`` is the wanted size in tokens; by default the greatest at which
    every listed source that has texts reaches its share within ``max_repeat``.
    Listed sources without texts give nothing and the others keep their
    proportions. With a ``total`` too large for a source, it gives all it may.

    Defined results: null or empty texts and texts without source are no
    candidates; equal texts are one text (of the least source and id) and never
    exceed ``max_repeat`` together; a null ``max_repeat`` is 1; ties of keys go
    by id; an empty table yields no row; other columns are ignored.
    """
    sized, b = _plan(docs, targets, total, seed, vocabulary)
    s = _ranged(sized.join(b.select("source", "epochs", "rest"), "source"))
    every = s.filter("epochs > 0").select("source", "doc_id", "n_tokens", F.col("epochs").alias("uses"))
    left, more = s.filter("n_tokens <= rest").drop("epochs"), None
    # a text that doesn't fit ends a prefix; those that still fit what is left go on, until none does
    while True:
        step = written(_take(left), "mixture-step")  # a few numbers a text; keeps each step's plan to itself
        now = step.filter("now").select("source", "doc_id", "n_tokens", F.lit(1).cast("long").alias("uses"))
        more = now if more is None else more.unionByName(now)
        left = step.filter("not now and n_tokens <= rest").drop("now")
        if left.isEmpty():
            break
    out = every.unionByName(more).groupBy("source", "doc_id", "n_tokens").agg(F.sum("uses").cast("int").alias("uses"))
    return out.select("doc_id", "source", "n_tokens", "uses")


def _ranged(s: DataFrame) -> DataFrame:
    """``s`` with ``slot``: ranges of keys, in order, of about TEXTS_PER_RANGE texts of a source at most."""
    bin_ = F.floor(F.log2("key") * BINS)
    s = s.withColumn("bin", bin_)
    parts = s.groupBy("source", "bin").agg(F.ceil(F.count("*") / float(TEXTS_PER_RANGE)).alias("parts"))
    s = s.join(parts, ["source", "bin"])
    low, high = F.pow(F.lit(2.0), F.col("bin") / BINS), F.pow(F.lit(2.0), (F.col("bin") + 1) / BINS)
    inside = F.least(F.greatest(F.floor((F.col("key") - low) / (high - low) * F.col("parts")), F.lit(0)), F.col("parts") - 1)  # keys lie evenly in so narrow a bin
    return s.withColumn("slot", F.struct("bin", inside.alias("part"))).drop("bin", "parts")


def _take(s: DataFrame) -> DataFrame:
    """``s`` with ``now``: the texts of the least keys of their source whose sum fits its ``rest``, which is reduced by them."""
    before = Window.partitionBy("source").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    slots = s.groupBy("source", "slot").agg(F.sum("n_tokens").alias("n")).select("source", "slot", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    inside = Window.partitionBy("source", "slot").orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    s = s.join(slots, ["source", "slot"]).withColumn("sum", F.col("ahead") + F.sum("n_tokens").over(inside)).withColumn("now", F.col("sum") <= F.col("rest"))
    gone = s.groupBy("source").agg(F.sum(F.when(F.col("now"), F.col("n_tokens")).otherwise(0)).alias("gone"))
    return s.join(gone, "source").withColumn("rest", F.col("rest") - F.col("gone")).drop("ahead", "sum", "gone")


def mixture_report(docs: DataFrame, targets: DataFrame, total: float | None = None, seed: int = 11, vocabulary: str = tokens.VOCABULARY) -> DataFrame:
    """Per listed source: target and reached share, tokens and texts available and used, the greatest number of uses."""
    m = mixture(docs, targets, total, seed, vocabulary)
    used = m.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("uses")).alias("used_tokens"), F.count("*").alias("n_texts"), F.max("uses").alias("most_uses"))
    t = targets.select("source", "target_share", "max_repeat").distinct().join(used, "source", "left").na.fill(0, ["used_tokens", "n_texts", "most_uses"])
    return t.withColumn("reached_share", F.col("used_tokens") / F.sum("used_tokens").over(Window.partitionBy(F.lit(1))))
