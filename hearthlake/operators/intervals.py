"""Left join of days with periods (``start <= day <= end``) as an equi-join on bins.

A plain range join is a nested loop, or, with a key, compares all days of the key with all its periods.
Here a period is spread over the bins of ``bin_days`` days that it touches and a day is looked up in its
one bin, so a day meets only the periods of its key around it; the exact check follows within the join.
Periods may overlap (a day then has a row for each), have any length, and be open: a null start or end
reaches to the first or last day of the table. Days without a period, without a key or null stay, with
nulls on the period's side. A period that ends before it starts holds no day.

The days are the streamed side and are never copied; a key that holds a third of them is a hot partition
of a sort-merge join, which adaptive execution splits. A period becomes one row for each bin it touches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BIN_DAYS = 28


def _bin(day: Column, bin_days: int) -> Column:
    return F.floor(F.datediff(day, F.lit("1970-01-01").cast("date")) / bin_days)


def interval_left_join(days: DataFrame, periods: DataFrame, key: str, day: str, start: str, end: str,
                       bin_days: int = BIN_DAYS) -> DataFrame:
    """All rows of ``days`` with the columns of each period of the same ``key`` that holds their ``day``.

    ``key`` is in both tables; the other columns of ``periods`` must have names of their own."""
    first, last = days.select(F.min(day)).scalar(), days.select(F.max(day)).scalar()
    low = F.greatest(F.coalesce(F.col(start), first), first)  # bins outside the days are of no use
    high = F.least(F.coalesce(F.col(end), last), last)
    others = [c for c in periods.columns if c != key]
    spread = (periods.where(low <= high)
              .select("*", F.explode(F.sequence(_bin(low, bin_days), _bin(high, bin_days))).alias("_bin"))
              .withColumnRenamed(key, "_key"))
    d = days.withColumn("_day_bin", _bin(F.col(day), bin_days))
    held = ((d[key] == spread["_key"]) & (d["_day_bin"] == spread["_bin"])
            & (spread[start].isNull() | (d[day] >= spread[start])) & (spread[end].isNull() | (d[day] <= spread[end])))
    return d.join(spread, held, "left").select(*[d[c] for c in days.columns], *[spread[c] for c in others])
