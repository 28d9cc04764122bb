"""What changed between full snapshots (problem 6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from codexgrid.functions.text import squash, strip
from codexgrid.plans.materialize import written


def snapshot_changes(
    rows: DataFrame,
    group: str = "regulation",
    snap: str = "snap_no",
    key: str = "uid",
    prev: str = "prev_uid",
    text: str = "text",
    loaded: str = "loaded_at",
) -> DataFrame:
    """Added, changed and removed keys of each snapshot against the one delivered before it.

    Every key is windowed over the index of its snapshots: the lagged text hash
    shows changes, a gap in the index shows a removal and a later addition. A
    new key whose predecessor ``prev`` ends at the same step is a change of it.
    The windows are partitioned by (group, key), so a hot group is spread over
    its keys; only (group, snapshot) pairs are ranked by group alone.

    Defined results: keys are trimmed and lower-cased; null or blank keys and
    rows without group or snapshot name no record and are left out; a null text
    equals an empty one; of a key given twice in a snapshot the row loaded last
    holds (ties: the greater text), all its ``prev`` values count; the first
    snapshot of a group yields nothing; an empty table yields no row. Other
    columns, whatever their names, are ignored.
    """
    clean = lambda c: F.lower(strip(F.col(c)))
    base = rows.select(
        F.col(group).alias("g"),
        F.col(snap).alias("s"),
        clean(key).alias("k"),
        clean(prev).alias("p"),
        F.col(loaded).alias("at"),
        F.xxhash64(squash(F.coalesce(F.col(text), F.lit("")))).alias("h"),
    )
    given = written(base.filter(F.col("g").isNotNull() & F.col("s").isNotNull()), "snapshot-rows")  # keys and hashes; three steps read them
    order = given.select("g", "s").distinct()
    by_group = Window.partitionBy("g").orderBy("s")
    steps = order.select("g", "s", F.row_number().over(by_group).alias("i"), F.lead("s").over(by_group).alias("s_next"))
    records = (
        given.filter(F.col("k") != "")
        .groupBy("g", "s", "k")
        .agg(F.max_by("h", F.struct("at", "h")).alias("h"), F.collect_set("p").alias("ps"))
        .join(steps, ["g", "s"])
    )
    by_key = Window.partitionBy("g", "k").orderBy("i")
    seen = records.select(
        "g", "s", "k", "i", "h", "ps", "s_next",
        F.lag("i").over(by_key).alias("i_before"),
        F.lag("h").over(by_key).alias("h_before"),
        F.lead("i").over(by_key).alias("i_after"),
    )
    kept = F.coalesce(F.col("i_before") == F.col("i") - 1, F.lit(False))
    edited = seen.filter(kept & (F.col("h") != F.col("h_before"))).select("g", F.col("s").alias("at"), "k", F.lit("changed").alias("kind"))
    new = seen.filter(~kept & (F.col("i") > 1)).select("g", F.col("s").alias("at"), "k", "ps")
    gone = seen.filter(F.col("s_next").isNotNull() & ~F.coalesce(F.col("i_after") == F.col("i") + 1, F.lit(False))).select("g", F.col("s_next").alias("at"), "k")
    # new and gone keys that meet over prev: one full outer join gives changed, added and removed
    left = new.select("g", "at", F.col("k").alias("new"), F.explode_outer("ps").alias("p"))
    right = gone.select(F.col("g").alias("g2"), F.col("at").alias("at2"), F.col("k").alias("old"))
    met = left.join(right, (F.col("g") == F.col("g2")) & (F.col("at") == F.col("at2")) & (F.col("p") == F.col("old")), "full_outer")
    fresh = (
        met.filter(F.col("new").isNotNull())
        .groupBy("g", "at", F.col("new").alias("k"))
        .agg(F.when(F.max(F.col("old").isNotNull()), F.lit("changed")).otherwise(F.lit("added")).alias("kind"))
    )
    lost = met.filter(F.col("new").isNull()).select(F.col("g2").alias("g"), F.col("at2").alias("at"), F.col("old").alias("k"), F.lit("removed").alias("kind"))
    return edited.unionByName(fresh).unionByName(lost).select(F.col("g").alias(group), F.col("at").alias(snap), F.col("k").alias(key), F.col("kind").alias("change_kind"))
