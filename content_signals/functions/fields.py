"""Nested text fields that a landed schema may or may not have."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T


def has_field(df: DataFrame, path: str) -> bool:
    kind: T.DataType = df.schema
    for name in path.split("."):
        if not isinstance(kind, T.StructType) or name not in kind.fieldNames():
            return False
        kind = kind[name].dataType
    return True


def text_field(df: DataFrame, *paths: str) -> Column:
    """Text of the first path that is there and not null, else ''."""
    found = [F.col(path).cast("string") for path in paths if has_field(df, path)]
    return F.coalesce(*found, F.lit(""))
