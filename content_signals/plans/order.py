"""Input order as data, and exact row numbers without one big sort task.

"Keep the first" and "ties in input order" need an order that survives
shuffles: the column ``_ord``, a whole number or a struct that ends in one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from content_signals.constants import ORD
from content_signals.plans.skew import lookup_join
from content_signals.plans.staging import stage

BUCKET_ROWS = 100_000
PAGE_ROWS = 100  # rows to expect of one landed page
MOST_SCORES = 100_000  # combinations of scores, whose totals one task sums up


def file_order() -> Column:
    """Order of a row read straight from files: file, block, place in the block.

    The running id is reproducible only directly above the scan, so add this
    column before anything else.
    """
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def _bucket(col: Column, kind: T.DataType, rows: int) -> Column:
    """Coarse order: in order, and with about ``rows`` rows to a value at most."""
    if not isinstance(kind, T.StructType):
        return F.floor(col / rows)
    first, last = kind.fields[0], kind.fields[-1]
    if isinstance(first.dataType, T.StructType):
        # (order of a page, place within the page): whole pages make up a bucket
        return _bucket(col[first.name], first.dataType, max(1, rows // PAGE_ROWS))
    head = [col[name].alias(name) for name in kind.fieldNames()[:-1]]
    return F.struct(*head, _bucket(col[last.name], last.dataType, rows).alias(last.name))


def _bucketed(df: DataFrame, groups: list[str], rows: int) -> tuple[DataFrame, DataFrame]:
    """The rows with ``_group`` and ``_bucket``, and the staged row count of each bucket.

    The counts are dealt by ranges of (group, bucket), numbered by ``_part``: sparse
    order keys, such as hashes, make as many buckets as rows.
    """
    keyed = df.withColumn("_group", F.struct(*groups)).withColumn(
        "_bucket", _bucket(F.col(ORD), df.schema[ORD].dataType, rows)
    )
    sizes = keyed.groupBy("_group", "_bucket").agg(F.count("*").alias("_rows"))
    ranged = sizes.repartitionByRange("_group", "_bucket").withColumn("_part", F.spark_partition_id())
    return keyed, stage(ranged, "bucket-sizes")


def _starts(sizes: DataFrame) -> DataFrame:
    """Rows of the group before each bucket: those of earlier parts and of its own part.

    One window sees the parts of a group, the other the buckets of one part of it.
    """
    def before(keys: list[str], order: str) -> Column:
        window = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("_rows").over(window), F.lit(0))

    parts = sizes.groupBy("_group", "_part").agg(F.sum("_rows").alias("_rows"))
    parts = parts.select("_group", "_part", before(["_group"], "_part").alias("_earlier"))
    within = sizes.withColumn("_within", before(["_group", "_part"], "_bucket"))
    return within.join(parts, ["_group", "_part"]).select(
        "_group", "_bucket", (F.col("_earlier") + F.col("_within")).alias("_start")
    )


def _numbered(keyed: DataFrame, starts: DataFrame, name: str) -> DataFrame:
    within = Window.partitionBy("_group", "_bucket").orderBy(ORD)
    return (
        keyed.join(starts, ["_group", "_bucket"])
        .withColumn(name, F.col("_start") + F.row_number().over(within))
        .drop("_group", "_bucket", "_start")
    )


def add_position(
    df: DataFrame, groups: list[str], name: str = "position", bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """Number the rows of each group 1, 2, ... in input order.

    A window over the whole group would sort a hot group in one task. Here the
    group is cut into order buckets of bounded size; a row's number is the
    count of rows in earlier buckets plus its place within its own.
    """
    keyed, sizes = _bucketed(df, groups, bucket_rows)
    return _numbered(keyed, _starts(sizes), name)


def first_rows(
    df: DataFrame, groups: list[str], limits: DataFrame, limit: str, bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """The first so many rows of each group in input order.

    ``limits`` holds each group's columns once and the number of rows in ``limit``; groups
    that it lacks go. The sums of earlier rows tell which order buckets begin beyond their
    group's limit. Rows of those never move: the buckets that are left are few where limits
    are, and are then sent to the rows. Only what they let through is numbered.
    """
    keyed, sizes = _bucketed(df, groups, bucket_rows)
    wanted = limits.select(F.struct(*groups).alias("_group"), F.col(limit).alias("_most"))
    starts = lookup_join(_starts(sizes), wanted, ["_group"], "inner", spread=F.col("_bucket"))
    starts = starts.filter(F.col("_start") < F.col("_most"))
    starts = stage(starts, "first-buckets")
    within = Window.partitionBy("_group", "_bucket").orderBy(ORD)
    place = F.col("_start") + F.row_number().over(within)
    kept = lookup_join(keyed, starts, ["_group", "_bucket"], "inner").withColumn("_place", place)
    return kept.filter(F.col("_place") <= F.col("_most")).select(*df.columns)


def add_rank_position(
    df: DataFrame, scores: list[str], name: str = "position", bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """Number all rows by descending scores, ties in input order.

    ``scores`` must be columns of few values (0..100 scores): the totals of their
    combinations are summed up in one task, so more than ``MOST_SCORES`` are an error.
    """
    keyed, sizes = _bucketed(df, scores, bucket_rows)
    if sizes.select("_group").distinct().limit(MOST_SCORES + 1).count() > MOST_SCORES:
        raise ValueError(f"more than {MOST_SCORES} combinations of {scores}")
    better = Window.orderBy(*[F.col("_group")[s].desc() for s in scores]).rowsBetween(
        Window.unboundedPreceding, -1
    )
    totals = sizes.groupBy("_group").agg(F.sum("_rows").alias("_rows"))
    above = totals.select(
        "_group", F.coalesce(F.sum("_rows").over(better), F.lit(0)).alias("_above")
    )
    starts = _starts(sizes).join(above, "_group")
    starts = starts.select("_group", "_bucket", (F.col("_start") + F.col("_above")).alias("_start"))
    return _numbered(keyed, starts, name)
