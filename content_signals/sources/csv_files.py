"""Source tables from CSV files."""

from __future__ import annotations

import csv

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from content_signals.constants import ORD, REQUIRED_SOURCE_COLUMNS
from content_signals.functions.text import null_na
from content_signals.plans.order import file_order
from content_signals.plans.skew import lookup_join
from content_signals.sources.csv_records import records

_CORRUPT, _WIDTH = "_corrupt_record", "_width"
_CSV = {"header": True, "escape": '"', "encoding": "UTF-8"}


def read_header(spark: SparkSession, path: str | list[str]) -> list[str]:
    """Column names of a CSV file; reads its first line."""
    try:
        return spark.read.options(**_CSV).csv(path).columns
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"CSV not found: {path}") from exc
        raise


def read_csv_text(
    spark: SparkSession,
    path: str | list[str],
    required: list[str] | None = None,
    bad_rows: str = "raise",
    multi_line: bool = True,
    na_null: bool = True,
    split: bool = True,
) -> DataFrame:
    """A CSV with a header as text columns plus ``_ord``.

    ``na_null`` makes the "no value" spellings null; without it only an empty cell
    is.

    A row with more cells than the header fails the job (``bad_rows="raise"``) or
    loses the surplus (``"permissive"``); missing cells are null. ``multi_line``
    allows line breaks within quotes: their ends are found by ``csv_records``, so that
    several tasks read a big file, or with ``split`` off by one task per file, which is
    cheaper for small ones. Without ``multi_line`` Spark splits at every line break.
    """
    names = read_header(spark, path)
    missing = [c for c in required or [] if c not in names]
    if missing:
        raise ValueError(f"missing required columns {missing} in {path}")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in names + [_CORRUPT]])
    width = F.lit(len(names))
    if multi_line and split:
        parsed = records(spark, path).filter("not is_header").select(_cells(schema).alias("row"), ORD, "is_header")
        raw = parsed.select("row.*", ORD, "is_header")
        # asked of a whole record only: the column keeps the check above the join that makes records
        width = F.when(~F.col("is_header"), len(names))
    else:
        reader = spark.read.schema(schema).options(**_CSV).option("multiLine", multi_line)
        # a parser that skips the cells of unused columns would not see surplus ones
        reader = reader.option("columnPruning", bad_rows != "raise")
        raw = reader.option("columnNameOfCorruptRecord", _CORRUPT).csv(path)
        raw = raw.withColumn(ORD, file_order())
    return _checked(raw, names, width, bad_rows, na_null)


def _cells(schema: T.StructType) -> Column:
    """The cells of ``record``."""
    options = {"escape": _CSV["escape"], "multiLine": "true", "columnNameOfCorruptRecord": _CORRUPT}
    return F.from_csv("record", F.lit(schema.toDDL()), options)


def _checked(raw: DataFrame, names: list[str], width: Column, bad_rows: str, na_null: bool) -> DataFrame:
    """Rows with more cells than ``width`` fail the job or lose them; ``raw`` holds the parser's bad record."""
    if bad_rows == "raise":
        unquoted = F.regexp_replace(_CORRUPT, r'"[^"]*"', "")
        surplus = F.size(F.split(unquoted, ",")) > width
        error = F.raise_error(F.concat(F.lit("too many cells in CSV row: "), F.col(_CORRUPT)))
        sound = F.when(F.col(_CORRUPT).isNotNull() & surplus, error.cast("boolean"))
        # Spark refuses a plan that reads the corrupt-row column alone, as a count
        # would; so the filter looks at a cell as well.
        raw = raw.filter(sound.otherwise(F.coalesce(F.length(F.col(names[0])), F.lit(0)) >= 0))
    cell = null_na if na_null else (lambda col: col)
    return raw.select(*[cell(F.col(c)).alias(c) for c in names], ORD)


def _with_boolean(df: DataFrame) -> DataFrame:
    if "processed" in df.columns and isinstance(df.schema["processed"].dataType, T.StringType):
        return df.withColumn("processed", F.col("processed").try_cast("boolean"))
    return df


def read_sources(
    spark: SparkSession, path: str | list[str], required: list[str] | None = None, **options
) -> DataFrame:
    """The source table: all text but ``processed``; errors name missing columns."""
    wanted = REQUIRED_SOURCE_COLUMNS if required is None else required
    return _with_boolean(read_csv_text(spark, path, wanted, **options))


def add_defaults(df: DataFrame, source_file: str = "master_sources.csv") -> DataFrame:
    """Add the optional columns that are absent; present ones are not filled."""
    defaults = {
        "origin_platform": F.lit(""),
        "prompt_template": F.lit("default"),
        "processed": F.lit(False),
        "notes": F.lit(""),
        "source_file": F.lit(source_file),
    }
    absent = {c: v for c, v in defaults.items() if c not in df.columns}
    return df.withColumns(absent) if absent else df


def read_sources_dir(
    spark: SparkSession, folder: str, pattern: str = "*.csv", mixed_headers: bool = False, **options
) -> DataFrame:
    """All CSV files of a folder that match the pattern, with ``source_file`` set.

    Files are taken to share one header. With ``mixed_headers`` every record is parsed by
    the header of its own file, and columns are put together by name. No matching file gives
    an empty table.
    """
    listing = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    if listing.select("path").isEmpty():
        return spark.createDataFrame([], T.StructType())
    if mixed_headers:
        named = _by_header(records(spark, folder, pattern), **options)
    else:
        named = read_csv_text(spark, f"{folder.rstrip('/')}/{pattern}", **options)
    source_file = F.regexp_extract(F.col(ORD)["file"], r"([^/]+)$", 1)
    return _with_boolean(named).withColumn("source_file", source_file)


def _by_header(
    rows: DataFrame, required: list[str] | None = None, bad_rows: str = "raise", na_null: bool = True
) -> DataFrame:
    """The records as columns of all headers, a cell null where the record's own header lacks it.

    A file's header is looked up by file. Only the distinct headers, of which there are as
    many as layouts and not as files, are brought together to name the columns; all
    layouts are parsed in one pass over the staged records.
    """
    headers = rows.filter("is_header").groupBy("file").agg(F.min("record").alias("header"))
    layouts = headers.groupBy("header").agg(F.min("file").alias("first")).select(F.struct("first", "header").alias("x"))
    layouts = layouts.agg(F.array_sort(F.collect_list("x"))).first()[0]
    known = {x.header: [c or f"_c{i}" for i, c in enumerate(next(csv.reader([x.header])))] for x in layouts}
    names = list(dict.fromkeys(c for columns in known.values() for c in columns))
    missing = [c for c in required or [] if c not in names]
    if missing:
        raise ValueError(f"missing required columns {missing}")
    cells = lookup_join(rows.filter("not is_header"), headers, ["file"], "inner", spread=F.col(ORD))
    parts: dict[str, list[Column]] = {c: [] for c in [*names, _CORRUPT, _WIDTH]}
    for i, (header, columns) in enumerate(known.items()):
        schema = T.StructType([T.StructField(c, T.StringType()) for c in columns + [_CORRUPT]])
        own = F.when(F.col("header") == header, _cells(schema))
        cells = cells.withColumn(f"_layout_{i}", own)
        for c in columns + [_CORRUPT]:
            parts[c].append(F.col(f"_layout_{i}")[c])
        parts[_WIDTH].append(F.when(F.col("header") == header, len(columns)))
    raw = cells.select(*[F.coalesce(*p).alias(c) for c, p in parts.items()], ORD)
    return _checked(raw, names, F.col(_WIDTH), bad_rows, na_null)
