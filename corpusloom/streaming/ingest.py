"""Incremental cleaning of a growing folder of JSON lines: the checkpoint remembers which files are done."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import text as T


def clean_new_files(spark: SparkSession, source: str, target: str, checkpoint: str, schema: str, least: int = 50) -> StreamingQuery:
    """Cleans what has come since the last run, keeps texts of *least* characters, and stops when all is done."""
    rows = spark.readStream.schema(schema).json(source).withColumn("text", T.clean_page(F.col("text")))
    return rows.where(F.length("text") >= least).writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
