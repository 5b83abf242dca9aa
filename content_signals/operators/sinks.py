"""Writers. Each writes one file per partition; nothing is gathered first."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from content_signals.constants import MASTER_COLUMNS, ORD
from content_signals.plans.order import add_position, add_rank_position


def _csv_cell(field: T.StructField, bool_style: str) -> Column:
    col = F.col(field.name)
    if isinstance(field.dataType, T.BooleanType) and bool_style == "title":
        return F.when(col, "True").when(~col, "False").alias(field.name)
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(col).alias(field.name)
    return col


def write_csv(
    df: DataFrame, path: str, bool_style: str = "title", mode: str = "overwrite"
) -> str:
    """UTF-8 CSV with header, by default replacing what is there.

    Quotes are doubled and cells may hold line breaks. ``bool_style``: ``title``
    writes True/False, ``lower`` true/false. The order column is left out.
    """
    cells = [_csv_cell(f, bool_style) for f in df.schema.fields if f.name != ORD]
    df.select(*cells).write.mode(mode).options(
        header=True,
        escape='"',
        encoding="UTF-8",
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    ).csv(path)
    return path


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    """Parquet, the format to prefer where no reader insists on CSV."""
    df.drop(ORD).write.mode("overwrite").partitionBy(*(partition_by or [])).parquet(path)
    return path


def write_master(df: DataFrame, path: str) -> str:
    """The strict six source columns as CSV; an empty table is an error."""
    if df.isEmpty():
        raise ValueError("no rows to write")
    return write_csv(df.select(*MASTER_COLUMNS), path)


def run_account(stats: DataFrame, summary: DataFrame, started_at: datetime, finished_at: datetime) -> DataFrame:
    """One row: a run's start and finish in UTC, its number of queries, and its totals by name."""
    totals = summary.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("metric", "value")))).alias("totals"))
    started, finished = (t.astimezone(timezone.utc).isoformat() for t in (started_at, finished_at))
    return totals.select(
        F.lit(started).alias("started_at"),
        F.lit(finished).alias("finished_at"),
        stats.agg(F.count("*").alias("n")).scalar().alias("query_count"),
        "totals",
    )


def write_telemetry(
    stats: DataFrame,
    summary: DataFrame,
    path: str,
    started_at: datetime | None = None,
    finished_at: datetime | None = None,
) -> tuple[str, str]:
    """Per-query statistics as JSON lines and the summary as CSV below ``path``.

    With the times of a run its account is written beside them, to ``run_json``.
    """
    detail, short = f"{path}/queries_json", f"{path}/summary_csv"
    stats.write.mode("overwrite").json(detail)
    write_csv(summary, short)
    if started_at and finished_at:
        run_account(stats, summary, started_at, finished_at).write.mode("overwrite").json(f"{path}/run_json")
    return detail, short


def name_prompts(df: DataFrame, rank_by: list[str] | None = None) -> DataFrame:
    """``(prompt_name, niche, text)`` of the non-empty prompts.

    ``prompt_001`` ... counts all rows, empty ones too: in input order, or by the
    descending scores ``rank_by``.
    """
    if rank_by:
        placed = add_rank_position(df, rank_by)
    else:
        placed = add_position(df.withColumn("_all", F.lit(0)), ["_all"])
    name = F.format_string("prompt_%03d", "position")
    filled = placed.filter(F.coalesce("final_prompt", F.lit("")) != "")
    return filled.select(name.alias("prompt_name"), "niche", F.col("final_prompt").alias("text"))


def export_prompt_text(df: DataFrame, path: str, rank_by: list[str] | None = None) -> str:
    """Write the named prompts as Parquet, one folder per niche."""
    return write_parquet(name_prompts(df, rank_by), path, ["niche"])
