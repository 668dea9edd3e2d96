"""Calendar expressions and the date spine."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ColumnOrName = Column | str


def days_between(start: dt.date, end: dt.date) -> Column:
    """Array of the days in [start, end)."""
    last = end - dt.timedelta(days=1)
    if last < start:
        return F.array().cast("array<date>")
    return F.sequence(F.lit(start), F.lit(last))


def date_spine(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row per day of [start, end), column ``date_day``."""
    return spark.range(1).select(F.explode(days_between(start, end)).alias("date_day"))


def spine_over(df: DataFrame, column: str) -> DataFrame:
    """One row per day from the earliest to the latest date in ``column``."""
    ends = df.agg(F.min(column).alias("first"), F.max(column).alias("last"))
    return ends.select(F.explode(F.sequence("first", "last")).alias("date_day"))


def day_of_week(day: ColumnOrName) -> Column:
    """0 = Sunday … 6 = Saturday."""
    return F.dayofweek(day) - 1


def is_weekend(day: ColumnOrName) -> Column:
    return F.dayofweek(day).isin(1, 7)


def tenure_days(since: ColumnOrName, as_of: Column) -> Column:
    return F.datediff(as_of, since)


def month_label(month_name: ColumnOrName, year: ColumnOrName) -> Column:
    """"Sep 2026" style label."""
    short = F.substring(month_name, 1, 3)
    return F.concat_ws(" ", short, F.col(year) if isinstance(year, str) else year)


def minutes_between(earlier: ColumnOrName, later: ColumnOrName) -> Column:
    """Elapsed minutes, fractional."""
    return F.timestamp_diff("MICROSECOND", earlier, later) / F.lit(60_000_000.0)
