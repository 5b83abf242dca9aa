"""Query specifications: what to search for and how much of it to take."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from content_signals.constants import DEFAULT_MAX_RESULTS, ORD, REQUIRED_QUERY_COLUMNS
from content_signals.functions.text import count_or_zero, text_or, trim_ws
from content_signals.sources.csv_files import read_csv_text

_GIVEN = T.StructType(
    [
        T.StructField(ORD, T.LongType()),
        T.StructField("query", T.StringType()),
        T.StructField("priority", T.StringType()),
        T.StructField("max_results", T.StringType()),
        T.StructField("min_views", T.StringType()),
    ]
)


def clean_query_specs(
    df: DataFrame, max_results: int = DEFAULT_MAX_RESULTS, strip_priority: bool = True
) -> DataFrame:
    """Typed specs: blank queries go, blanks and junk get defaults.

    A ``max_results`` of 0 or junk becomes the default while a negative one is
    kept. ``strip_priority=False`` only puts the priority in upper case.
    """
    wanted = count_or_zero(F.coalesce("max_results", F.lit("")))
    priority = text_or(F.col("priority"), "MEDIUM") if strip_priority else F.col("priority")
    return df.select(
        trim_ws(F.coalesce("query", F.lit(""))).alias("query"),
        F.upper(F.coalesce(priority, F.lit("MEDIUM"))).alias("priority"),
        F.when(wanted == 0, max_results).otherwise(wanted).cast("bigint").alias("max_results"),
        count_or_zero(F.coalesce("min_views", F.lit(""))).alias("min_views"),
        ORD,
    ).filter(F.col("query") != "")


def read_query_specs(
    spark: SparkSession, path: str, max_results: int = DEFAULT_MAX_RESULTS, **options
) -> DataFrame:
    """Specs from a CSV with at least query, priority, max_results and min_views."""
    raw = read_csv_text(spark, path, REQUIRED_QUERY_COLUMNS, na_null=False, **options)
    return clean_query_specs(raw, max_results)


def query_specs_from_list(
    spark: SparkSession, specs: Iterable[str | dict], max_results: int = DEFAULT_MAX_RESULTS
) -> DataFrame:
    """Specs from texts (all defaults) or from dicts with the same four keys."""
    rows = []
    for place, spec in enumerate(specs):
        given = spec if isinstance(spec, dict) else {"query": spec}
        cells = [given.get(c) for c in REQUIRED_QUERY_COLUMNS]
        rows.append((place, *[None if c is None else str(c) for c in cells]))
    return clean_query_specs(spark.createDataFrame(rows, _GIVEN), max_results, strip_priority=False)
