"""Lines found in many documents, dropped from all but one of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from content_signals.llm.common import stage, text_key
from content_signals.plans.skew import lookup_join

MIN_CHARS = 40
MIN_DOCUMENTS = 5
#: White space that a line's key loses at both ends; a fixed value.
_STRIPPED = r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+\z"
#: A-Z and a-z; fixed values. ``lower`` would change other letters too.
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    return F.translate(F.regexp_replace(line, _STRIPPED, ""), _UPPER, _LOWER)


def _digest(key: Column) -> Column:
    """128 bits, so that equal digests mean equal lines."""
    return F.unhex(F.md5(key))


def drop_common_lines(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS
) -> DataFrame:
    """The rows of ``docs`` with ``row``, ``kept_text``, ``n_lines`` and ``n_dropped``.

    ``row`` holds the given columns as they came, so that no name can clash. A
    line's key is the line without white space at its ends and with A-Z in lower
    case. A key of at least ``min_chars`` code points that stands in at least
    ``min_documents`` documents loses its lines everywhere except in the largest
    ``doc_id`` that holds it, where all of them stay.

    A null or empty text is one empty line. Rows that share a ``doc_id`` are one
    document. A row without ``doc_id`` is not counted and keeps all its lines.

    Lines travel as (document, position, digest), written once to the shared folder
    so that texts are cut and hashed once. Documents are counted in two
    steps, first per (digest, document), so that a line found everywhere is
    summed before its rows meet. The common lines are sent to all tasks where they have been
    measured to be few; beyond that, lines found everywhere are looked up in parts.
    """
    given = docs.select(F.struct("*").alias("row")).select(
        "row",
        F.col("row.doc_id").alias("doc"),
        text_key(F.col("row.text")).alias("key"),
        F.split(F.coalesce("row.text", F.lit("")), "\n", -1).alias("lines"),
    )
    numbered = given.filter("doc is not null").select(
        "doc", "key", F.posexplode("lines").alias("pos", "line")
    )
    # the line's own length bounds its key's, and is cheap to test
    long_enough = numbered.filter(F.length("line") >= min_chars).withColumn("line", line_key(F.col("line")))
    hashed = long_enough.filter(F.length("line") >= min_chars).select(
        "doc", "key", "pos", _digest(F.col("line")).alias("digest")
    )
    hashed = stage(hashed, "line-digests")
    per_document = hashed.groupBy("digest", "doc").agg(F.lit(1).alias("one"))
    common = (
        per_document.groupBy("digest")
        .agg(F.count("one").alias("documents"), F.max("doc").alias("keeper"))
        .filter(F.col("documents") >= min_documents)
        .select("digest", "keeper")
    )
    common = stage(common, "common-lines")
    dropped = (
        lookup_join(hashed, common, ["digest"], "inner", spread=F.col("doc"))
        .filter(F.col("doc") != F.col("keeper"))
        .groupBy("doc", "key")
        .agg(F.collect_set("pos").alias("dropped"))
    )
    joined = given.drop("lines").join(dropped, ["doc", "key"], "left")
    lines = F.split(F.coalesce("row.text", F.lit("")), "\n", -1)
    places = F.sequence(F.lit(0), F.size("lines") - 1)
    kept = F.transform(F.array_except(places, F.col("dropped")), lambda i: F.get(F.col("lines"), i))
    whole = F.coalesce("row.text", F.lit(""))
    return joined.withColumn("lines", lines).select(
        "row",
        F.when(F.col("dropped").isNull(), whole).otherwise(F.array_join(kept, "\n")).alias("kept_text"),
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
    )
