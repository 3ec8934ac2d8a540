"""Date and time parsing/formatting for schedule rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_dmy_hm(date_text: Column | str, time_text: Column | str, lenient: bool = False) -> Column:
    """Naive local datetime from ``D/M/YYYY`` and ``H:MM`` (one or two digits,
    like ``strptime('%d/%m/%Y %H:%M')``).  Bad text raises unless ``lenient``."""
    text = F.concat_ws(" ", _c(date_text), _c(time_text))
    fmt = F.lit("d/M/yyyy H:mm")
    return F.try_to_timestamp(text, fmt).cast("timestamp_ntz") if lenient \
        else F.to_timestamp_ntz(text, fmt)


def hour_iso(ts: Column | str) -> Column:
    """Floor to the hour and format as ``YYYY-MM-DDTHH:00``.  Formats the hour
    field directly, so a naive datetime never passes through the session's
    time zone."""
    return F.date_format(_c(ts), "yyyy-MM-dd'T'HH':00'")
