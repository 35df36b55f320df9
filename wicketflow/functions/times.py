"""Time expressions over ISO texts with a zone and no seconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_MINUTES = "yyyy-MM-dd'T'HH:mmXXX"


def parse_start(col: Column) -> Column:
    """Null for an empty text or another form."""
    return F.try_to_timestamp(col, F.lit(ISO_MINUTES))


def start_date(col: Column) -> Column:
    """The UTC date of a start time, whatever the session's zone."""
    return F.to_date(F.to_utc_timestamp(parse_start(col), F.current_timezone()))


def year_text(col: Column) -> Column:
    return F.substring_index(col, "-", 1)
