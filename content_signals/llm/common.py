"""Shared by the operators: tables, Arrow batches, bounded label samples."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from content_signals.plans.staging import stage

__all__ = ["as_bytes", "bounded_sample", "slices", "stage", "table", "text_key"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_key(text: Column) -> Column:
    """Tells apart rows that share an id but not their text; equal rows get equal results."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of a text column, null as empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Batches cut so that a column holds about ``limit`` bytes; a longer row stands alone."""
    for batch in batches:
        start = size = 0
        for i, length in enumerate(pc.binary_length(batch.column(column)).to_pylist()):
            length = length or 0
            if i > start and size + length > limit:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += length
        if start < batch.num_rows:
            yield batch.slice(start)


def bounded_sample(rows: DataFrame, key: str, bound: int, seed: int) -> DataFrame:
    """At most ``bound`` rows in an order fixed by a hash of ``key``.

    Only narrow rows may be handed in: the result is kept small enough to
    broadcast, so that long texts are fetched for the chosen rows alone.
    """
    return rows.orderBy(F.xxhash64(F.lit(seed), F.col(key)), F.col(key)).limit(bound)
