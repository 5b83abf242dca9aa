"""Corpus-level trend scores: recency, keyword frequency, recurring themes.

The text is cut once: a narrow table holds each row's order, words and theme, the words
as Parquet's dictionary codes. Keywords and themes are counted from it, exactly, and rows are
scored against the counts; the scores go back to the rows by their order. No window runs
over the whole corpus and no count reaches the driver.

Words are exploded with the outer variant throughout: for the inner one Catalyst
adds a filter on the array's size, which would cut the text into words twice.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from content_signals.constants import DATE_COLUMNS, ORD, TREND_WEIGHTS
from content_signals.functions.keywords import (
    first_keyword,
    is_keyword,
    keyword_text,
    keywords,
    words,
)
from content_signals.functions.text import trim_ws
from content_signals.functions.times import utc
from content_signals.plans.skew import fits_broadcast, lookup_join, salted_join
from content_signals.plans.staging import stage

NEUTRAL = 0.5
# Rows are first matched against this many of the most frequent keywords.
HOT_KEYWORDS = 512
LEADING_KEYWORDS = 16

DATE_FORMATS = [
    "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS][XXX]",
    "yyyy-MM-dd HH:mm:ss[.SSSSSS][.SSS][XXX]",
    "yyyy-MM-dd",
    "yyyy/M/d",
    "yyyyMMdd",
    "M/d/yyyy",
    "MMM d, yyyy",
    "MMMM d, yyyy",
    "d MMM yyyy",
    "d MMMM yyyy",
]


def parse_timestamp(col: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Timestamp of a date text by the first format that fits, else null."""
    text = trim_ws(col)
    return F.coalesce(
        F.try_to_timestamp(text), *[F.try_to_timestamp(text, F.lit(f)) for f in formats]
    )


def recency_score(df: DataFrame, as_of: datetime, formats: Sequence[str] = DATE_FORMATS) -> DataFrame:
    """Add ``recency_score``: 1 for ``as_of`` or later, 0 for the oldest row of the
    table, 0.5 for a row without a date."""
    name = next((c for c in DATE_COLUMNS if c in df.columns), None)
    if name is None:
        return df.withColumn("recency_score", F.lit(NEUTRAL))
    col = F.col(name)
    if not isinstance(df.schema[name].dataType, (T.TimestampType, T.DateType)):
        col = parse_timestamp(col.cast("string"), formats)
    seconds = F.unix_micros(utc(as_of)) - F.unix_micros(col.cast("timestamp"))
    age = seconds / F.lit(1_000_000.0) / F.lit(86400.0)
    oldest = df.agg(F.greatest(F.max(age), F.lit(1.0)).alias("days")).scalar()
    score = F.greatest(F.lit(0.0), F.least(F.lit(1.0) - age / oldest, F.lit(1.0)))
    # greatest and least skip nulls, so a missing date is tested for itself
    return df.withColumn("recency_score", F.when(age.isNull(), NEUTRAL).otherwise(score))


def extract_keywords(df: DataFrame, name: str = "keywords", nan_as_token: bool = False) -> DataFrame:
    """Add the array of the row's keywords, in order, with repeats."""
    return df.withColumn(name, keywords(keyword_text(df, nan_as_token)))


def token_counts(df: DataFrame, nan_as_token: bool = False) -> DataFrame:
    """``(token, n)``: occurrences of each keyword in the whole table."""
    found = df.select(F.explode_outer(words(keyword_text(df, nan_as_token))).alias("token"))
    return found.filter(is_keyword(F.col("token"))).groupBy("token").agg(F.count("*").alias("n"))


def _theme(lower_text: Column, df: DataFrame) -> Column:
    """The first keyword, else the niche in upper case, else UNKNOWN."""
    niche = F.coalesce(F.col("niche"), F.lit("")) if "niche" in df.columns else F.lit("")
    fallback = F.upper(F.coalesce(F.nullif(niche, F.lit("")), F.lit("UNKNOWN")))
    return F.coalesce(first_keyword(lower_text), fallback)


def signals(df: DataFrame, nan_as_token: bool = False) -> DataFrame:
    """``(_ord, _words, _theme)`` of every row, staged: all that is ever read of the text.

    ``_words`` are the letter and digit runs in order, keywords or not.
    """
    texts = df.withColumn("_text", keyword_text(df, nan_as_token))
    cut = texts.select(ORD, words(F.col("_text")).alias("_words"), _theme(F.col("_text"), df).alias("_theme"))
    return stage(cut, "signals")


def keyword_counts(cut: DataFrame) -> DataFrame:
    """``(token, n)``, staged: occurrences of each keyword in the ``signals``."""
    found = cut.select(F.explode_outer("_words").alias("token")).filter(is_keyword(F.col("token")))
    return stage(found.groupBy("token").agg(F.count("*").alias("n")), "keyword-counts")


def _frequency_scores(cut: DataFrame, hot_keywords: int) -> DataFrame:
    """``(_ord, frequency_score)`` of the ``signals``.

    A row's dominant keyword is nearly always among the most frequent ones. They
    are few, so a row is matched against them in place, most frequent first, with
    no shuffle. Rows that hold none of them are scored by a join on keyword; a
    cold word, too, may have many rows, and is then salted.
    """
    tokens = keyword_counts(cut)
    top = tokens.orderBy(F.desc("n"), "token").limit(hot_keywords)
    ranked = F.sort_array(F.collect_list(F.struct(F.col("n"), F.col("token"))), asc=False)
    hot = top.agg(
        F.struct(
            F.transform(ranked, lambda x: x["token"]).alias("token"),
            F.transform(ranked, lambda x: x["n"]).alias("n"),
        )
    ).scalar()

    def best(tokens: Column) -> Column:
        return F.get(F.array_intersect(tokens, F.col("_words")), F.lit(0))

    # a match among the very first spares most rows the rest of the list
    leading = F.slice(hot["token"], 1, LEADING_KEYWORDS)
    place = F.array_position(hot["token"], F.coalesce(best(leading), best(hot["token"])))
    highest = F.get(hot["n"], F.lit(0))
    direct = F.get(hot["n"], (place - 1).cast("int")) / highest
    neutral = F.lit(NEUTRAL)
    if tokens.count() <= hot_keywords:
        return cut.select(ORD, F.coalesce(direct, neutral).alias("frequency_score"))

    unmatched = F.when(~F.arrays_overlap("_words", hot["token"]), F.array_distinct("_words"))
    exploded = cut.select(ORD, F.explode_outer(unmatched).alias("token"))
    cold = stage(exploded.filter(is_keyword(F.col("token"))), "cold-words")
    if cold.isEmpty():
        return cut.select(ORD, F.coalesce(direct, neutral).alias("frequency_score"))
    # the scores are no more rows than the cold words, so that what was measured bounds both
    small = fits_broadcast(cold)
    counted = tokens.join(F.broadcast(cold), "token") if small else salted_join(cold, tokens, ["token"], "inner")
    scores = counted.groupBy(ORD).agg((F.max("n") / highest).alias("_cold"))
    joined = cut.join(F.broadcast(scores) if small else scores, ORD, "left")
    return joined.select(ORD, F.coalesce("_cold", direct, neutral).alias("frequency_score"))


def _theme_scores(cut: DataFrame) -> DataFrame:
    """``(_ord, multi_source_score)`` of the ``signals``."""
    themes = stage(cut.groupBy("_theme").agg(F.count("*").alias("n")), "theme-counts")
    highest = themes.agg(F.max("n").alias("n")).scalar()
    scores = themes.select("_theme", (F.col("n") / highest).alias("multi_source_score"))
    return lookup_join(cut.select(ORD, "_theme"), scores, ["_theme"], "inner", counts=themes).drop("_theme")


def _with_scores(df: DataFrame, *scores: DataFrame) -> DataFrame:
    """The rows with their scores, joined by ``_ord``, which is unique."""
    both = reduce(lambda a, b: a.join(b, ORD), scores)
    return df.join(stage(both, "signal-scores"), ORD).select(*df.columns, *[c for c in both.columns if c != ORD])


def frequency_score(
    df: DataFrame, hot_keywords: int = HOT_KEYWORDS, nan_as_token: bool = False
) -> DataFrame:
    """Add ``frequency_score``: count of the row's most frequent keyword over the
    highest count of any; 0.5 for a row without keywords."""
    return _with_scores(df, _frequency_scores(signals(df, nan_as_token), hot_keywords))


def multi_source_score(df: DataFrame, nan_as_token: bool = False) -> DataFrame:
    """Add ``multi_source_score``: rows with the row's theme over rows with the top theme."""
    theme = _theme(keyword_text(df, nan_as_token), df)
    return _with_scores(df, _theme_scores(stage(df.select(ORD, theme.alias("_theme")), "themes")))


def weighted_score(df: DataFrame) -> DataFrame:
    """Add ``trend_score``: weighted mean of the sub-scores that are present."""
    total, weight = F.lit(0.0), F.lit(0.0)
    for name, share in TREND_WEIGHTS.items():
        if name in df.columns:
            score = F.col(name).cast("double")
            total = total + F.coalesce(score * F.lit(share), F.lit(0.0))
            weight = weight + F.when(score.isNotNull(), share).otherwise(0.0)
    mean = F.when(weight > 0, total / weight).otherwise(F.lit(NEUTRAL))
    return df.withColumn("trend_score", F.greatest(F.lit(0.0), F.least(mean, F.lit(1.0))))


def trend_score(
    df: DataFrame,
    as_of: datetime,
    hot_keywords: int = HOT_KEYWORDS,
    nan_as_token: bool = False,
) -> DataFrame:
    """Add the three sub-scores and ``trend_score``; needs ``_ord``."""
    cut = signals(df, nan_as_token)
    dated = recency_score(df, as_of)
    return weighted_score(_with_scores(dated, _frequency_scores(cut, hot_keywords), _theme_scores(cut)))


def priority_level(df: DataFrame) -> DataFrame:
    """Add ``priority_level`` from ``trend_score``; both thresholds are fixed values."""
    score = F.col("trend_score")
    return df.withColumn(
        "priority_level",
        F.when(score >= F.lit(0.65), "HIGH").when(score >= F.lit(0.40), "MEDIUM").otherwise("LOW"),
    )


def priority_counts(df: DataFrame) -> DataFrame:
    """``(priority_level, n)``, most frequent first."""
    return df.groupBy("priority_level").agg(F.count("*").alias("n")).orderBy(F.desc("n"))
