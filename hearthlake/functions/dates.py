"""Calendar helpers (session time zone pinned to UTC by ``build_session``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_of(ts) -> Column:
    """Calendar day of a timestamp, as DATE."""
    return F.to_date(_col(ts))


def week_start(d) -> Column:
    """Monday of the (ISO, Monday-Sunday) week containing ``d``, as DATE."""
    return F.date_trunc("week", _col(d)).cast("date")


def week_end(d) -> Column:
    """Sunday of the week containing ``d``, as DATE."""
    return F.date_add(week_start(d), 6)
