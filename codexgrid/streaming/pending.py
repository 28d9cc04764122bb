"""Pending rows as a stream: rows given again are dropped, untranslated ones go on as they arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from codexgrid.functions import blocks as B


def pending(spark: SparkSession, path: str, late: str = "30 days") -> DataFrame:
    """The untranslated paragraphs that arrive as Parquet files under ``path``, each block once within the time that late rows may take."""
    schema = spark.read.parquet(path).schema
    rows = spark.readStream.schema(schema).parquet(path).withColumn("loaded_at", F.col("loaded_at").cast("timestamp"))
    return rows.withWatermark("loaded_at", late).filter((B.kind(F.col("type")) == "paragraph") & (F.col("status") == "untranslated")).dropDuplicatesWithinWatermark(["block_id"])


def enrich_stream(rows: DataFrame, enrich: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Run ``enrich`` on each batch and append its rows to ``out``; a batch repeated after a failure replaces its own files."""

    def write(batch: DataFrame, batch_id: int) -> None:
        enrich(batch).withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(out)

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
