"""Text and number columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from content_signals.constants import NA_TOKENS, WHITESPACE

_PLAIN_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_PLAIN_INTEGER = r"^[+-]?[0-9]+(_[0-9]+)*$"


def trim_ws(col: Column) -> Column:
    """Strip Unicode white space at both ends (Spark's own trim knows only the space)."""
    return F.btrim(col, F.lit(WHITESPACE))


def text_or(col: Column, default: str) -> Column:
    """Stripped text; null and blank become the default."""
    return F.coalesce(F.nullif(trim_ws(col), F.lit("")), F.lit(default))


def null_na(col: Column) -> Column:
    """Null for every spelling of "no value" in a source CSV."""
    return F.when(~col.isin(NA_TOKENS), col)


def plain_number(col: Column) -> Column:
    """Double for plain decimal text, else null.

    Spark alone would also read Java literals such as ``92f`` and give NaN for
    ``NaN``; both are junk here.
    """
    text = trim_ws(col)
    return F.when(text.rlike(_PLAIN_NUMBER), text.try_cast("double"))


def count_or_zero(col: Column) -> Column:
    """Long for integer text, 0 for anything else; ``1_000`` is a thousand."""
    text = trim_ws(col.cast("string"))
    digits = F.replace(text, F.lit("_"), F.lit(""))
    number = F.when(text.rlike(_PLAIN_INTEGER), digits.try_cast("bigint"))
    return F.coalesce(number, F.lit(0).cast("bigint"))


def title_case(col: Column) -> Column:
    """Upper-case the first letter after every non-letter: ``o'neil-x`` -> ``O'Neil-X``."""
    runs = F.regexp_extract_all(F.lower(col), F.lit(r"\p{L}+|\P{L}+"), F.lit(0))
    words = F.transform(
        runs, lambda w: F.concat(F.upper(F.left(w, F.lit(1))), F.right(w, F.length(w) - 1))
    )
    return F.array_join(words, "")


def json_text(col: Column) -> Column:
    """A text column as a quoted and escaped JSON string."""
    boxed = F.to_json(F.array(F.coalesce(col, F.lit(""))))
    return F.substring(boxed, F.lit(2), F.length(boxed) - 2)


def first_match(col: Column, rules: list[tuple[str, list[str]]], default: str) -> Column:
    """Label of the first rule one of whose words the text holds."""
    out = None
    for label, words in rules:
        hit = col.contains(words[0])
        for word in words[1:]:
            hit = hit | col.contains(word)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return F.lit(default) if out is None else out.otherwise(default)
