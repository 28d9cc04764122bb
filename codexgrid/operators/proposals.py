"""Pending amendments: attached to their targets and inserted after their anchors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codexgrid.operators.ordered import DOC, renumbered

FIELDS = ("id", "type", "number", "title", "text_new", "justification", "source_date", "source_label")


def latest(proposals: DataFrame) -> DataFrame:
    """Each id once, as loaded last."""
    return proposals.groupBy("id").agg(F.max_by(F.struct(*[c for c in proposals.columns if c != "id"]), "loaded_at").alias("x")).select("id", "x.*")


def attached(rows: DataFrame, proposals: DataFrame) -> DataFrame:
    """``rows`` with ``proposals``: those for the row's uid in its regulation, newest first (equal dates by id)."""
    one = F.struct(F.coalesce("source_date", F.lit("")).alias("_d"), *FIELDS)
    newest = lambda a, b: F.when(a["_d"] > b["_d"], -1).when(a["_d"] < b["_d"], 1).when(a["id"] < b["id"], -1).when(a["id"] > b["id"], 1).otherwise(0)
    lists = proposals.filter("type <> 'ADDED' and target_uid is not null").groupBy("regulation", F.col("target_uid").alias("uid")).agg(F.array_sort(F.collect_list(one), newest).alias("_p"))
    d = rows.join(lists, ["regulation", "uid"], "left")
    return d.withColumn("proposals", F.transform("_p", lambda x: F.struct(*[x[c].alias(c) for c in FIELDS]))).drop("_p")


def inserted(rows: DataFrame, proposals: DataFrame) -> DataFrame:
    """``rows`` with a virtual row for each addition after its anchor (oldest first), renumbered; ``proposal_only`` marks them."""
    p = proposals.filter("type = 'ADDED' and anchor_uid is not null").select("regulation", F.col("anchor_uid").alias("uid"), F.col("id").alias("_id"), F.col("number").alias("_number"), F.col("title").alias("_title"), F.coalesce("source_date", F.lit("")).alias("_date"))
    met = rows.select(*DOC, "uid", "pos", "level", "parent").join(p, ["regulation", "uid"])
    anchors = met.groupBy(*DOC, "pos").agg(F.array_sort(F.collect_list(F.struct("_date", "_id", "_number", "_title", "level", "parent"))).alias("_l"))
    new = anchors.select(*DOC, F.col("pos").alias("_anchor"), F.posexplode("_l").alias("_k", "_x"))
    values = {"uid": F.concat(F.lit("PROPOSAL-"), F.col("_x._id")), "number": F.coalesce("_x._number", F.lit("")), "title": F.coalesce("_x._title", F.lit("")), "text": F.lit(""), "level": F.col("_x.level"), "parent": F.col("_x.parent"), "type": F.lit("paragraph"), "status": F.lit("proposal"), "modified": F.lit(False)}
    keep = [f for f in rows.schema if f.name not in (*DOC, "pos")]
    virtual = new.select(*DOC, F.col("_anchor").alias("_order"), (F.col("_k") + 1).alias("_tie"), *((values[f.name] if f.name in values else F.lit(None)).cast(f.dataType).alias(f.name) for f in keep), F.lit(True).alias("proposal_only"))
    real = rows.select(*DOC, F.col("pos").alias("_order"), F.lit(0).alias("_tie"), *(f.name for f in keep), F.lit(False).alias("proposal_only"))
    return renumbered(real.unionByName(virtual), order=F.col("_order"), tie=F.col("_tie"), cut=True).drop("_order", "_tie")
