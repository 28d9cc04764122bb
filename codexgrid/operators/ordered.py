"""Running values over the rows of a document, however long it is.

A window over a whole document would put a third of all rows into one task
where one document holds them. Here positions are cut into chunks: values of
chunks are combined first (one row a chunk), then each chunk runs on its own
with what came before it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codexgrid.plans.materialize import written

CHUNK = 4096
DOC = ("regulation", "version")


@dataclass(frozen=True)
class Run:
    """One running value: ``kind`` max, min, sum, last (not null) or lag (of the row before); ``own`` includes the row itself."""

    kind: str
    value: Column
    own: bool = False


def running(df: DataFrame, runs: dict[str, Run], doc: tuple[str, ...] = DOC, pos: Column | None = None, tie: Column | None = None, cut: bool = False) -> DataFrame:
    """``df`` with a column for each run.

    ``pos`` orders a document and is what chunks are cut from (default column
    pos; -pos runs backwards); ``tie`` orders rows of equal ``pos``, which share
    a chunk. The rows are read twice: ``cut`` writes them first, so that a chain
    of steps doesn't double with every call.
    """
    if cut:
        df = written(df, "ordered")
    at = F.col("pos") if pos is None else pos
    df = df.withColumn("_at", F.struct(at.cast("long").alias("p"), (F.lit(0) if tie is None else tie).cast("long").alias("t")))
    df = df.withColumn("_chunk", F.floor(F.col("_at.p") / CHUNK))
    value = {n: F.struct(r.value.alias("v")) if r.kind == "lag" else r.value for n, r in runs.items()}

    def total(n: str, r: Run) -> Column:
        if r.kind in ("last", "lag"):
            return F.max_by(value[n], F.when(value[n].isNotNull(), F.col("_at")))
        return {"max": F.max, "min": F.min, "sum": F.sum}[r.kind](value[n])

    def over(c: Column, kind: str, w) -> Column:
        if kind in ("last", "lag"):
            return F.last(c, ignorenulls=True).over(w)
        return {"max": F.max, "min": F.min, "sum": F.sum}[kind](c).over(w)

    before = Window.partitionBy(*doc).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = df.groupBy(*doc, "_chunk").agg(*(total(n, r).alias(f"_t_{n}") for n, r in runs.items()))
    carry = chunks.select(*(F.col(d).alias(f"_k_{d}") for d in doc), F.col("_chunk").alias("_k_chunk"), *(over(F.col(f"_t_{n}"), r.kind, before).alias(f"_c_{n}") for n, r in runs.items()))
    same = F.col("_chunk") == F.col("_k_chunk")
    for d in doc:
        same = same & F.col(d).eqNullSafe(F.col(f"_k_{d}"))
    joined = df.join(carry, same)
    for n, r in runs.items():
        inside = Window.partitionBy(*doc, "_chunk").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0 if r.own else -1)
        here, c = over(value[n], r.kind, inside), F.col(f"_c_{n}")
        if r.kind == "sum":
            out = F.coalesce(here, F.lit(0)) + F.coalesce(c, F.lit(0))
        elif r.kind == "max":
            out = F.when(here.isNull(), c).when(c.isNull(), here).otherwise(F.when(here >= c, here).otherwise(c))
        elif r.kind == "min":
            out = F.when(here.isNull(), c).when(c.isNull(), here).otherwise(F.when(here <= c, here).otherwise(c))
        else:
            out = F.coalesce(here, c)
        joined = joined.withColumn(n, out["v"] if r.kind == "lag" else out)
    return joined.drop("_at", "_chunk", "_k_chunk", *(f"_k_{d}" for d in doc), *(f"_c_{n}" for n in runs))


def renumbered(df: DataFrame, doc: tuple[str, ...] = DOC, order: Column | None = None, tie: Column | None = None, name: str = "pos", cut: bool = False) -> DataFrame:
    """``df`` with consecutive positions from 0 by ``order``, then ``tie``, chunk by chunk."""
    one = running(df, {"_n": Run("sum", F.lit(1))}, doc, order, tie, cut)
    return one.withColumn(name, F.col("_n").cast("int")).drop("_n")
