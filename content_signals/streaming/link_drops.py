"""Links dropped as text files, one URL to a line."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from content_signals.functions.text import trim_ws
from content_signals.functions.times import utc


def _to_sources(lines: DataFrame, added_at: Column, niche: str) -> DataFrame:
    url = trim_ws(F.col("value"))
    return lines.select(
        url.alias("source_url"),
        F.lit(niche).alias("niche"),
        F.lit(False).alias("processed"),
        added_at.alias("added_at"),
    ).filter(F.col("source_url").startswith("http"))


def read_link_drops(
    spark: SparkSession,
    folder: str,
    pattern: str = "*.txt",
    niche: str = "MOTIVATION",
    added_at: datetime | None = None,
) -> DataFrame:
    """All links of a drop folder; other lines are left out."""
    lines = spark.read.option("pathGlobFilter", pattern).text(folder)
    return _to_sources(lines, utc(added_at or datetime.now(timezone.utc)), niche)


def ingest_link_drops(
    spark: SparkSession,
    folder: str,
    table_path: str,
    checkpoint: str,
    pattern: str = "*.txt",
    niche: str = "MOTIVATION",
    files_per_batch: int = 10_000,
) -> None:
    """Append the links of files not seen before to a Parquet source table.

    Runs until all present files are in, then stops. The checkpoint remembers the
    files and the sink commits each batch once, so a rerun after a failure neither
    loses nor repeats a link. The query keeps no state.
    """
    lines = (
        spark.readStream.format("text")
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(folder)
    )
    query = (
        _to_sources(lines, F.current_timestamp(), niche)
        .writeStream.format("parquet")
        .option("path", table_path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
