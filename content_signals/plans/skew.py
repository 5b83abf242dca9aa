"""Lookups that stay sound when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from content_signals.constants import ORD
from content_signals.plans.staging import stage

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 * 1024 * 1024
ROWS_PER_TASK = 1_000_000  # a key with more rows is heavy, and split into parts of that size
MOST_HEAVY = 10_000  # bounds the heavy keys, which are broadcast: parts grow beyond it


def _row_bytes(df: DataFrame) -> Column:
    """Size of a row's text and nested values; 16 bytes for any other."""
    total = F.lit(0).cast("bigint")
    for field in df.schema.fields:
        col = F.col(field.name)
        if isinstance(field.dataType, T.StringType):
            total = total + F.coalesce(F.octet_length(col), F.lit(0))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            total = total + F.coalesce(F.octet_length(F.to_json(F.struct(col))), F.lit(0))
        else:
            total = total + 16
    return total


def measured(df: DataFrame, rows: int = BROADCAST_ROWS) -> tuple[int, int]:
    """Rows and bytes of a table, of which no more than ``rows + 1`` rows are read."""
    sizes = df.select(_row_bytes(df).alias("size")).limit(rows + 1)  # only sizes go to one task
    return tuple(sizes.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first())


def fits_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether a table has been measured to be small enough to send to every executor."""
    n, total = measured(df, rows)
    return n <= rows and total <= size


def heavy_keys(counts: DataFrame, keys: list[str], target: int = ROWS_PER_TASK) -> DataFrame:
    """``(keys..., _salts)``: keys with more rows than a task should get, and their parts.

    ``counts`` is a table ``(keys..., n)``. There are at most ``MOST_HEAVY`` such keys.
    """
    part = counts.agg(F.greatest(F.sum("n") / MOST_HEAVY, F.lit(target).cast("double"))).scalar()
    heavy = counts.filter(F.col("n") > part)
    return stage(heavy.select(*keys, F.ceil(F.col("n") / part).cast("int").alias("_salts")), "heavy-keys")


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    how: str = "left",
    spread: Column | None = None,
    counts: DataFrame | None = None,
    target: int = ROWS_PER_TASK,
) -> DataFrame:
    """Join a table to a lookup table, spreading heavy and null keys over tasks.

    ``right`` holds each key once. Rows of a heavy key get one of so many salts that
    ``target`` rows share one, and the key's lookup row is repeated for each; other
    keys are left alone. Rows without a key match nothing and are spread at will.
    ``counts`` gives the rows per key of ``left`` when they are already known.
    """
    if counts is None:
        counts = left.groupBy(*keys).agg(F.count("*").alias("n"))
    heavy = heavy_keys(counts, keys, target)
    spread = F.col(ORD) if spread is None else spread
    no_key = F.lit(False)
    for key in keys:
        no_key = no_key | F.col(key).isNull()
    hashed = F.xxhash64(spread)
    salted = left.join(F.broadcast(heavy), keys, "left").withColumn(
        "_salt",
        F.when(no_key, (hashed % F.lit(1 << 30)).cast("int"))
        .when(F.col("_salts").isNotNull(), F.pmod(hashed, F.col("_salts")).cast("int"))
        .otherwise(0),
    )
    all_salts = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    repeated = right.join(F.broadcast(heavy), keys, "left").withColumn(
        "_salt", F.explode(all_salts)
    )
    return salted.drop("_salts").join(repeated.drop("_salts"), keys + ["_salt"], how).drop("_salt")


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    how: str = "left",
    spread: Column | None = None,
    counts: DataFrame | None = None,
    rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Join to a lookup table that holds each key once.

    Broadcast when the table has been measured to be small, salted otherwise.
    """
    if fits_broadcast(right, rows):
        return left.join(F.broadcast(right), keys, how)
    return salted_join(left, right, keys, how, spread, counts)
