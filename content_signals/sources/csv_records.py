"""Records of CSV files whose quoted cells may hold line breaks, with the files read in splits.

A line break ends a record only outside quotes, so what a line means depends on all lines
before it. But a line does no more than turn one state, inside quotes or not, into another:
it keeps the state, flips it, or sets it. Such steps can be put together: the state after
some lines is what the last line that set it left, flipped as often as flips came after. So
every split works out its own lines and its step as a whole; the steps of a file's splits,
one row each, give every split the state it begins in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from content_signals.constants import ORD
from content_signals.plans.order import file_order
from content_signals.plans.skew import lookup_join
from content_signals.plans.staging import stage

#: A whole cell at the start of a line or after a comma; doubled quotes have been taken out.
_CELL = r'(?:^|,)(?:"[^"]*"[^,]*|[^",][^,]*)'
_SPLIT = ["file", "block"]


def _left_open(text: Column) -> Column:
    """Whether the last cell of a text that begins outside quotes is still open at its end.

    Whole cells are taken away from the left, one match each; a quote left over opens one.
    """
    return F.regexp_replace(text, _CELL, "").contains('"')


def _step(line: Column) -> tuple[Column, Column]:
    """Whether a line ends inside quotes: begun outside them, and begun inside."""
    single = F.replace(line, F.lit('""'), F.lit(""))
    closing = F.instr(single, '"')
    rest = F.regexp_replace(F.substring(single, closing + 1, F.length(single)), r"^[^,]*", "")
    return _left_open(single), (closing == 0) | _left_open(rest)


def _composed(df: DataFrame, window: Window) -> DataFrame:
    """Add ``fixed`` and ``flips``: the steps of all rows up to each one, put together.

    ``fixed`` is the state that the last row to set it leads to, null if there is none; after
    a row the state is then ``fixed``, else the state at the outset, flipped if ``flips``.
    ``from_out`` and ``from_in`` are the states each row leads to.
    """
    so_far = window.rowsBetween(Window.unboundedPreceding, 0)
    flip = (F.col("from_out") & ~F.col("from_in")).cast("long")
    turned = df.withColumn("_turns", F.sum(flip).over(so_far))
    sets = F.col("from_out") == F.col("from_in")
    at = F.when(sets, F.struct(F.col("from_out").alias("state"), F.col("_turns").alias("turns")))
    last = F.last(at, ignorenulls=True).over(so_far)
    return turned.withColumn("_last", last).select(
        *df.columns,
        F.col("_last.state").alias("fixed"),
        ((F.col("_turns") - F.coalesce("_last.turns", F.lit(0))) % 2 == 1).alias("flips"),
    )


def _state(step: str, start: Column) -> Column:
    """The state after a step of the two columns; before any step that at the outset."""
    fixed, flips = (F.col(f"{step}{c}") for c in ("fixed", "flips"))
    return F.coalesce(fixed, start) != F.coalesce(flips, F.lit(False))


def records(spark: SparkSession, path: str | list[str], pattern: str | None = None) -> DataFrame:
    """``(file, record, is_header, _ord)``: the records of CSV files, line breaks within quotes kept.

    ``_ord`` names file, split and line where the record begins. The first record of a file
    that is not blank is its header; blank records are left out. A quote that is never
    closed runs on to the end of its file. Lines are shuffled once, by split, and written to
    the staging folder, so that the files are read once; only the lines of records that
    span several are shuffled again.
    """
    reader = spark.read.option("lineSep", "\n")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    lines = reader.text(path).withColumn(ORD, file_order()).select("value", f"{ORD}.*")
    unmarked = F.when(F.col("block") == 0, F.regexp_replace("value", r"^\x{FEFF}", "")).otherwise(F.col("value"))
    lines = lines.withColumn("value", unmarked)
    out, into = _step(F.col("value"))
    within = Window.partitionBy(*_SPLIT).orderBy("row")
    stepped = _composed(lines.withColumn("from_out", out).withColumn("from_in", into), within)
    stepped = stepped.withColumn("prev", F.lag(F.struct("fixed", "flips")).over(within))
    # where the record of a line begins, for either state at the outset of the split
    for state in (0, 1):
        begins = ~_state("prev.", F.lit(bool(state)))
        so_far = within.rowsBetween(Window.unboundedPreceding, 0)
        start = F.last(F.when(begins, F.col("row")), ignorenulls=True).over(so_far)
        stepped = stepped.withColumn(f"start_{state}", start)
    stepped = stage(stepped.drop("from_out", "from_in"), "csv-lines")

    last = F.max_by(F.struct("fixed", "flips", "start_0", "start_1"), "row").alias("end")
    splits = stepped.groupBy(*_SPLIT).agg(last).select(
        *_SPLIT,
        "end.start_0",
        "end.start_1",
        _state("end.", F.lit(False)).alias("from_out"),
        _state("end.", F.lit(True)).alias("from_in"),
    )
    of_file = Window.partitionBy("file").orderBy("block")
    entered = _composed(splits, of_file).withColumn("_entered", F.lag(_state("", F.lit(False))).over(of_file))
    entered = entered.withColumn("_entered", F.coalesce("_entered", F.lit(False)))
    own = F.when(F.col("_entered"), F.col("start_1")).otherwise(F.col("start_0"))
    own = F.when(own.isNotNull(), F.struct("block", own.alias("row")))
    earlier = of_file.rowsBetween(Window.unboundedPreceding, -1)
    entered = entered.withColumn("_carried", F.last(own, ignorenulls=True).over(earlier))

    placed = lookup_join(stepped, entered.select(*_SPLIT, "_entered", "_carried"), _SPLIT, spread=F.col("row"))
    begun = F.when(F.col("_entered"), F.col("start_1")).otherwise(F.col("start_0"))
    begun = F.when(begun.isNotNull(), F.struct("block", begun.alias("row"))).otherwise(F.col("_carried"))
    begins_open, ends_open = _state("prev.", F.col("_entered")), _state("", F.col("_entered"))
    placed = placed.select("file", "block", "row", "value", begun.alias("start"), (begins_open | ends_open).alias("partial"))
    parts = placed.filter("partial").groupBy("file", "start").agg(
        F.array_sort(F.collect_list(F.struct("block", "row", "value"))).alias("parts")
    )
    joined = F.array_join(F.transform("parts", lambda x: x["value"]), "\n")
    whole = placed.filter("not partial").select("file", "start", F.col("value").alias("record"))
    whole = whole.unionByName(parts.select("file", "start", joined.alias("record")))
    whole = whole.filter(~F.col("record").isin("", "\r"))
    first = whole.filter("start.block = 0").groupBy("file").agg(
        F.min(F.struct("start", F.regexp_like("record", F.lit(r"^[^\n]*\r(\n|\z)")).alias("crlf"))).alias("_first")
    )
    marked = lookup_join(whole, first, ["file"], spread=F.col("start"))
    # a file whose first line ends in both characters has them made one everywhere
    record = F.regexp_replace("record", r"\r\z", "")
    record = F.when(F.col("_first.crlf"), F.replace(record, F.lit("\r\n"), F.lit("\n"))).otherwise(record)
    return marked.select(
        "file",
        record.alias("record"),
        F.coalesce(F.col("start") == F.col("_first.start"), F.lit(False)).alias("is_header"),
        F.struct("file", F.col("start.block").alias("block"), F.col("start.row").alias("row")).alias(ORD),
    )
