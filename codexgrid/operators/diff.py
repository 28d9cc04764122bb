"""Comparing two versions of documents: every row unchanged, modified, moved, added or deleted.

Old and new rows have the key columns of the document, pos, uid, number, title
and text. Equal identities meet in a hash join; what is left meets in a
similarity join and is matched one to one, best pairs first.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from codexgrid.functions import blocks as B
from codexgrid.operators.similarity import ratio_udf, similar_texts, spread
from codexgrid.plans.materialize import written

MOVED = 0.92
MODIFIED = 0.50
GATHERED = 200_000  # pairs of a document that one task matches


def best_first(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """The one-to-one pairs that taking the best pair again and again gives (ties: lower left, then right id).

    Documents of at most GATHERED pairs are matched in one task each. Of larger
    ones no group is gathered: a pair that is the best of both its ends is in
    the result whatever the others are; those are taken, their ends removed, and
    so on.
    """
    pairs = written(pairs, "matching")
    size = pairs.groupBy(*keys).agg(F.count("*").alias("_size"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pairs.schema)

    def greedy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right = set(), set()  # of all the task's documents
        for batch in batches:
            docs = list(zip(*(batch[k].to_pylist() for k in keys)))
            keep = []
            for doc, i, j in zip(docs, batch["left_id"].to_pylist(), batch["right_id"].to_pylist()):
                keep.append((doc, i) not in left and (doc, j) not in right)
                if keep[-1]:
                    left.add((doc, i))
                    right.add((doc, j))
            yield batch.filter(pa.array(keep, pa.bool_()))

    small = pairs.join(size.filter(F.col("_size") <= GATHERED).select(*keys), keys, "left_semi").select(*pairs.columns)
    small = small.repartition(spread(small), *keys).sortWithinPartitions(F.col("similarity").desc(), "left_id", "right_id")
    done = small.mapInArrow(greedy, fields)
    left = pairs.join(size.filter(F.col("_size") > GATHERED).select(*keys), keys, "left_semi").select(*pairs.columns)
    rank = F.struct(F.col("similarity"), -F.col("left_id"), -F.col("right_id"))
    while not left.isEmpty():
        l, r = Window.partitionBy(*keys, "left_id"), Window.partitionBy(*keys, "right_id")
        won = written(left.withColumn("_r", rank).withColumn("_l", F.max("_r").over(l)).withColumn("_m", F.max("_r").over(r)).filter("_r = _l and _r = _m").drop("_r", "_l", "_m"), "matched")
        done = done.unionByName(won)
        left = written(left.join(won.select(*keys, "left_id"), [*keys, "left_id"], "left_anti").join(won.select(*keys, "right_id"), [*keys, "right_id"], "left_anti"), "matching")
    return done


def diff(old: DataFrame, new: DataFrame, keys: list[str], fuzzy: bool = True) -> DataFrame:
    """Entries: keys, type, uid, prev_uid, number, title, text_new, text_old, similarity, pos (of the new row; null for DELETED).

    Equal identity: UNCHANGED, or MODIFIED if the texts' ratio is from 0.5 to
    under 1 (below that UNCHANGED too, as the identity decides). Matched by
    likeness: SLID from 0.92, MODIFIED from 0.5. The rest: ADDED and DELETED.
    Without ``fuzzy`` the second step is left out. Identities count once on the
    old side (the last row) and once a row on the new side.
    """
    o = old.select(*keys, F.col("pos").alias("o_pos"), F.col("uid").alias("uid"), F.col("number").alias("o_number"), F.col("title").alias("o_title"), F.coalesce("text", F.lit("")).alias("o_text"))
    last = o.groupBy(*keys, "uid").agg(F.max_by(F.struct("o_pos", "o_number", "o_title", "o_text"), "o_pos").alias("x")).select(*keys, "uid", "x.*")
    n = new.select(*keys, "pos", "uid", "number", "title", F.coalesce("text", F.lit("")).alias("text"))
    out = lambda d, kind, prev, text_new, text_old, sim, pos: d.select(*keys, kind.alias("type"), "uid", prev.alias("prev_uid"), "number", "title", text_new.alias("text_new"), text_old.alias("text_old"), sim.alias("similarity"), pos.alias("pos"))
    none_s, none_d, none_i = F.lit(None).cast("string"), F.lit(None).cast("double"), F.lit(None).cast("int")

    same = n.join(last, [*keys, "uid"])
    equal = same.filter("text = o_text")
    other = same.filter("text <> o_text").withColumn("_s", ratio_udf("o_text", "text"))
    changed = F.col("_s") >= MODIFIED
    entries = out(equal, F.lit("UNCHANGED"), F.col("uid"), F.col("text"), none_s, none_d, F.col("pos")).unionByName(
        out(other, F.when(changed, "MODIFIED").otherwise("UNCHANGED"), F.col("uid"), F.col("text"), F.when(changed, F.col("o_text")), F.when(changed, F.bround("_s", 4)), F.col("pos"))
    )
    rest_n = n.join(last.select(*keys, "uid"), [*keys, "uid"], "left_anti")
    rest_o = last.join(n.select(*keys, "uid").distinct(), [*keys, "uid"], "left_anti")
    if fuzzy:
        rest_n, rest_o = written(rest_n, "diff-new"), written(rest_o, "diff-old")
        pairs = similar_texts(rest_o.select(*keys, F.col("o_pos").cast("long").alias("id"), F.col("o_text").alias("text")), rest_n.select(*keys, F.col("pos").cast("long").alias("id"), "text"), keys, MODIFIED)
        # the earlier new row wins a tie, then the earlier old one
        turned = pairs.select(*keys, F.col("right_id").alias("left_id"), F.col("left_id").alias("right_id"), "similarity")
        won = best_first(turned, keys).select(*keys, F.col("left_id").cast("int").alias("pos"), F.col("right_id").cast("int").alias("o_pos"), "similarity")
        won = written(won, "diff-won")  # three joins read it
        met = rest_n.join(won, [*keys, "pos"]).join(rest_o.select(*keys, "o_pos", F.col("uid").alias("o_uid"), "o_text"), [*keys, "o_pos"])
        entries = entries.unionByName(out(met, F.when(F.col("similarity") >= MOVED, "SLID").otherwise("MODIFIED"), F.col("o_uid"), F.col("text"), F.col("o_text"), F.bround("similarity", 4), F.col("pos")))
        rest_n = rest_n.join(won, [*keys, "pos"], "left_anti")
        rest_o = rest_o.join(won, [*keys, "o_pos"], "left_anti")
    entries = entries.unionByName(out(rest_n, F.lit("ADDED"), none_s, F.col("text"), none_s, none_d, F.col("pos")))
    gone = rest_o.select(*keys, "uid", F.col("o_number").alias("number"), F.col("o_title").alias("title"), "o_text")
    return entries.unionByName(out(gone, F.lit("DELETED"), F.col("uid"), none_s, F.col("o_text"), none_d, none_i))


def ordered_entries(entries: DataFrame, keys: list[str]) -> DataFrame:
    """Entries by numeric path (blank as 0, what is no number last), then by pass."""
    number = F.when(F.trim(B.text0(F.col("number"))) == "", F.lit("0")).otherwise(F.col("number"))
    rank = F.when(F.col("type").isin("UNCHANGED"), 0).when(F.col("type").isin("MODIFIED", "SLID"), 1).when(F.col("type") == "ADDED", 2).otherwise(3)
    return entries.orderBy(*keys, B.path(number).asc_nulls_last(), rank, F.col("pos").asc_nulls_last(), "uid")


def summary(entries: DataFrame, keys: list[str]) -> DataFrame:
    """Entries of each type."""
    return entries.groupBy(*keys, "type").agg(F.count("*").alias("n"))


def report(entries: DataFrame, keys: list[str]) -> DataFrame:
    """Per document: counts by type (a map) and the changes (an array without UNCHANGED, in order)."""
    s = summary(entries, keys).groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("type", "n")))).alias("summary"))
    number = F.when(F.trim(B.text0(F.col("number"))) == "", F.lit("0")).otherwise(F.col("number"))
    one = F.struct(B.path(number).alias("path"), F.col("pos"), F.col("type"), F.col("uid"), F.col("prev_uid"), F.col("number"), F.col("title"), F.col("text_new"), F.col("text_old"), F.col("similarity"))
    c = entries.filter("type <> 'UNCHANGED'").groupBy(*keys).agg(F.array_sort(F.collect_list(one)).alias("changes"))
    return s.join(c, keys, "left")


def applied(new: DataFrame, entries: DataFrame, keys: list[str]) -> DataFrame:
    """New rows with modified, prev_uid, text_old and status set from their entries; all other columns stay.

    MODIFIED makes a row untranslated again, SLID leaves its status.
    """
    e = entries.filter("pos is not null and type in ('MODIFIED', 'SLID')").select(*keys, "pos", F.col("type").alias("_type"), F.col("prev_uid").alias("_prev"), F.col("text_old").alias("_old"))
    d = new.join(e, [*keys, "pos"], "left")
    hit = F.col("_type").isNotNull()
    keep = lambda c, kind: F.col(c) if c in new.columns else F.lit(None).cast(kind)
    return d.withColumns({
        "modified": F.when(hit, True).otherwise(F.coalesce(keep("modified", "boolean"), F.lit(False))),
        "prev_uid": F.when(hit, F.col("_prev")).otherwise(keep("prev_uid", "string")),
        "text_old": F.when(hit, F.col("_old")).otherwise(keep("text_old", "string")),
        "status": F.when(F.col("_type") == "MODIFIED", "untranslated").otherwise(keep("status", "string")),
    }).drop("_type", "_prev", "_old")


def consecutive(rows: DataFrame, group: str = "regulation", snap: str = "snap_no") -> tuple[DataFrame, DataFrame]:
    """(old, new) rows of each snapshot and the one before it, both under (group, snap of the later)."""
    order = rows.select(group, snap).distinct()
    steps = order.withColumn("_next", F.lead(snap).over(Window.partitionBy(group).orderBy(snap)))
    old = rows.join(steps.filter("_next is not null"), [group, snap]).drop(snap).withColumnRenamed("_next", snap)
    new = rows.join(steps.select(group, F.col("_next").alias(snap)).filter(f"{snap} is not null"), [group, snap], "left_semi")
    return old, new
