"""Aggregate measures shared by models and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from excursio.schemas import LOST_STATUSES

ALL = "All"


def row_count(name: str = "n") -> Column:
    return F.count(F.lit(1)).alias(name)


def count_where(condition: Column) -> Column:
    """Rows meeting the condition; a NULL condition is not counted, empty input gives 0."""
    return F.count_if(condition)


def with_status(status: str) -> Column:
    return F.count_if(F.col("booking_status") == status)


def confirmed_amount() -> Column:
    confirmed = F.col("booking_status") == "CONFIRMED"
    return F.sum(F.when(confirmed, F.col("booking_amount")).otherwise(0.0))


def lost_bookings() -> Column:
    return F.count_if(F.col("booking_status").isin(*LOST_STATUSES))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Fraction as double; NULL when the denominator is zero or NULL."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def choose(**equals: str | None) -> Column:
    """Conjunction of equality filters; ``None`` or "All" filters nothing."""
    condition = F.lit(True)
    for column, value in equals.items():
        if value is not None and value != ALL:
            condition = condition & (F.col(column) == value)
    return condition


def distinct_where(df: DataFrame, condition: Column, column: str, name: str) -> DataFrame:
    """One row: how many distinct values the rows meeting the condition hold."""
    return df.filter(condition).agg(F.countDistinct(column).alias(name))


def value_distribution(df: DataFrame, column: str) -> DataFrame:
    """Share of each value, NULL included."""
    total = df.agg(row_count("n")).scalar()
    counts = df.groupBy(column).agg(row_count("n_rows"))
    return counts.withColumn("share", ratio(F.col("n_rows"), total))
