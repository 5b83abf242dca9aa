"""Keywords of a source row.

A keyword is a lower-case run of letters a-z and digits of more than two
characters that is not a stop word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from content_signals.constants import STOPWORDS

KEYWORD_COLUMNS = ["title", "notes", "source_url", "niche"]

_FIRST = (
    r"(?<![a-z0-9])(?!(?:" + "|".join(STOPWORDS) + r")(?![a-z0-9]))[a-z0-9]{3,}"
)


def keyword_text(df: DataFrame, nan_as_token: bool = False) -> Column:
    """Title, notes, URL and niche in lower case, joined by blanks; absent columns
    count as blank.

    ``nan_as_token`` writes ``nan`` for a null cell of a present column, which
    then counts as a keyword; by default a null is blank.
    """
    blank = F.lit("nan" if nan_as_token else "")
    parts = [
        F.coalesce(F.col(c).cast("string"), blank) if c in df.columns else F.lit("")
        for c in KEYWORD_COLUMNS
    ]
    return F.lower(F.concat_ws(" ", *parts))


def words(lower_text: Column) -> Column:
    """All letter/digit runs, keywords or not; there may be empty ones at the ends."""
    return F.split(lower_text, "[^a-z0-9]+")


def is_keyword(word: Column) -> Column:
    return (F.length(word) > 2) & ~word.isin(STOPWORDS)


def keywords(lower_text: Column) -> Column:
    """The keywords in order, with repeats."""
    return F.filter(words(lower_text), is_keyword)


def first_keyword(lower_text: Column) -> Column:
    """The first keyword or null; the rest of the text is not read."""
    return F.nullif(F.regexp_extract(lower_text, _FIRST, 0), F.lit(""))
