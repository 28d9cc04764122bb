"""The registry of core queries, their SQL twins and what several of them read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codexgrid.operators import diff as D
from codexgrid.operators import proposals, report
from codexgrid.plans.materialize import written
from codexgrid.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register a query under ``name`` with its SQL twin, if it has one."""

    def put(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = sql
        return f

    return put


COL = F.col
BLOCKS = "WITH b AS (SELECT * FROM structured QUALIFY row_number() OVER (PARTITION BY block_id ORDER BY loaded_at DESC) = 1)"
PARA = f"{BLOCKS}, p AS (SELECT *, try_cast(split_part(number, '.', 1) AS INT) AS top, coalesce(type, 'paragraph') AS kind FROM b)"


def blocks(spark: SparkSession, sf_dir: str, columns: str = "") -> DataFrame:
    """The current rows of ``structured`` with the columns named (by blanks; default: all)."""
    return report.current(table(spark, sf_dir, "structured"), *columns.split())


def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "doc_versions")


def pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    return proposals.latest(table(spark, sf_dir, "proposals"))


def snapshot_pairs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    s = table(spark, sf_dir, "structured_snapshots")
    s = s.withColumn("uid", F.lower(F.trim("uid"))).groupBy("regulation", "snap_no", "pos").agg(F.max_by(F.struct("uid", "number", "title", "text"), F.struct("loaded_at", "row_id")).alias("x")).select("regulation", "snap_no", "pos", "x.*")
    return D.consecutive(written(s, "snapshots"))  # three steps read it


SNAPS = """WITH s AS (SELECT regulation, snap_no, pos, lower(trim(uid)) AS uid, number, title, coalesce(text, '') AS text FROM structured_snapshots QUALIFY row_number() OVER (PARTITION BY regulation, snap_no, pos ORDER BY loaded_at DESC, row_id DESC) = 1),
st AS (SELECT regulation, snap_no, lag(snap_no) OVER (PARTITION BY regulation ORDER BY snap_no) AS before FROM (SELECT DISTINCT regulation, snap_no FROM s)),
n AS (SELECT s.* FROM s JOIN st USING (regulation, snap_no) WHERE before IS NOT NULL),
o0 AS (SELECT s.regulation, st.snap_no, s.pos, s.uid, s.number, s.title, s.text FROM s JOIN st ON s.regulation = st.regulation AND s.snap_no = st.before),
o AS (SELECT * FROM o0 QUALIFY row_number() OVER (PARTITION BY regulation, snap_no, uid ORDER BY pos DESC) = 1)"""
