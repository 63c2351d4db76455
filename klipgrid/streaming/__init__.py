"""The log-shaped inputs as streams: the same rules, kept in Spark's state store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ingest import eligible
from ..params import Listing
from ..schemas import DOWNLOAD_LOG, MANIFEST


def manifest_stream(spark: SparkSession, folder: str, p: Listing = Listing()) -> DataFrame:
    """Eligible manifest rows of a growing folder of JSON lines, first of each id."""
    rows = spark.readStream.schema(MANIFEST).json(folder)
    return rows.where(eligible(F.col("duration"), F.lit(None).cast("string"), F.col("url"), p)).dropDuplicates(["id"])


def hourly_outcomes(spark: SparkSession, folder: str, late: str | None = None) -> DataFrame:
    """Outcomes per hour and status, of all lines however late: the state is one row per hour and status.

    With ``late`` hours are closed after that delay, and lines that come still later
    are left out; only then may the result be appended instead of updated.
    """
    rows = spark.readStream.schema(DOWNLOAD_LOG).json(folder).withColumn("at", F.timestamp_seconds("t"))
    rows = rows if late is None else rows.withWatermark("at", late)
    return rows.groupBy(F.window("at", "1 hour"), "status").agg(F.count(F.lit(1)).alias("n"))
