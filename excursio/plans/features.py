"""Feature models at (experience, day) grain.

The windows are partitioned by experience. The input holds one row per experience and
calendar day, so a partition is bounded by the length of ``dim_date`` however hot an
experience is in the raw tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from excursio.warehouse import Warehouse

CALENDAR_COLUMNS = ["day_of_week", "is_weekend", "month", "quarter", "day_name"]
BASE_COLUMNS = [
    "experience_id",
    "feature_date",
    *CALENDAR_COLUMNS,
    "city",
    "category",
    "capacity",
    "rating",
    "base_price",
    "avg_price",
    "target_bookings",
    "target_confirmed_bookings",
    "target_cancellation_rate",
    "target_utilization_rate",
]
ROLLING_COLUMNS = [
    "bookings_prev_1d",
    "bookings_prev_7d_avg",
    "bookings_prev_28d_avg",
    "utilization_prev_7d_avg",
    "cancellation_rate_prev_28d_avg",
    "days_of_prior_history",
]
TARGET_COLUMNS = [c for c in BASE_COLUMNS if c.startswith("target_")]
FEATURE_COLUMNS = [
    *[c for c in BASE_COLUMNS if c not in TARGET_COLUMNS],
    *ROLLING_COLUMNS,
    *TARGET_COLUMNS,
]


def ml_daily_price(wh: Warehouse) -> DataFrame:
    slots = wh.table("fact_experience_availability")
    return slots.groupBy("experience_id", "date_day").agg(F.avg("price").alias("avg_price"))


def with_calendar(wh: Warehouse, df: DataFrame, day: str) -> DataFrame:
    """Inner join to the calendar; broadcast is safe, it is as long as its date range."""
    calendar = wh.table("dim_date").select(F.col("date_day").alias(day), *CALENDAR_COLUMNS)
    return df.join(F.broadcast(calendar), day)


def ml_base_features(wh: Warehouse) -> DataFrame:
    days = wh.table("experience_days").select(
        "experience_id",
        F.col("experience_date").alias("feature_date"),
        "city",
        "category",
        "capacity",
        "rating",
        "base_price",
        "avg_price",
        F.col("total_bookings").alias("target_bookings"),
        F.col("confirmed_bookings").alias("target_confirmed_bookings"),
        F.col("cancellation_rate").alias("target_cancellation_rate"),
        F.col("utilization_rate").alias("target_utilization_rate"),
    )
    return with_calendar(wh, days, "feature_date").select(*BASE_COLUMNS)


def add_history(base: DataFrame, by_day: bool = False) -> DataFrame:
    """Trailing features that never see the current row.

    Frames count rows, as the feature contract does: with a missing day "previous" means the
    previous row. ``by_day`` counts calendar days instead.
    """
    ordered = Window.partitionBy("experience_id").orderBy("feature_date")
    day_number = F.datediff("feature_date", F.lit("1970-01-01").cast("date"))
    in_days = Window.partitionBy("experience_id").orderBy(day_number)

    def trailing(days: int) -> WindowSpec:
        return in_days.rangeBetween(-days, -1) if by_day else ordered.rowsBetween(-days, -1)

    bookings, used = F.col("target_bookings"), F.col("target_utilization_rate")
    cancelled = F.col("target_cancellation_rate")
    previous = F.max(bookings).over(trailing(1)) if by_day else F.lag(bookings, 1).over(ordered)
    return base.select(
        "*",
        previous.alias("bookings_prev_1d"),
        F.avg(bookings).over(trailing(7)).alias("bookings_prev_7d_avg"),
        F.avg(bookings).over(trailing(28)).alias("bookings_prev_28d_avg"),
        F.avg(used).over(trailing(7)).alias("utilization_prev_7d_avg"),
        F.avg(cancelled).over(trailing(28)).alias("cancellation_rate_prev_28d_avg"),
        (F.row_number().over(ordered) - 1).alias("days_of_prior_history"),
    )


def ml_rolling_features(wh: Warehouse) -> DataFrame:
    return add_history(wh.table("ml_base_features"))


def ml_demand_features(wh: Warehouse) -> DataFrame:
    return wh.table("ml_rolling_features").select(*FEATURE_COLUMNS)


MODELS = {
    "ml_daily_price": ml_daily_price,
    "ml_base_features": ml_base_features,
    "ml_rolling_features": ml_rolling_features,
    "ml_demand_features": ml_demand_features,
}
