"""Points in time, independent of the session's time zone."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, functions as F


def utc(moment: datetime) -> Column:
    """A timestamp literal; a datetime without a zone is taken to be UTC."""
    aware = moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)
    epoch = datetime(1970, 1, 1, tzinfo=timezone.utc)
    return F.timestamp_micros(F.lit((aware - epoch) // timedelta(microseconds=1)))
