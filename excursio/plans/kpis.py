"""Dashboard queries and governed metrics.

Booking measures are rolled up per experience before the join to ``dim_experience``: counts
and sums add up, so the result is the same, while the join sees one row per experience (and
extra key) instead of every booking and a hot experience cannot overload it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from excursio.functions.rules import LEAD_TIME_BUCKETS, lead_time_bucket
from excursio.functions.scalars import position_in
from excursio.operators.measures import (
    choose,
    confirmed_amount,
    lost_bookings,
    ratio,
    row_count,
)
from excursio.schemas import FUNNEL_STAGES
from excursio.warehouse import Warehouse

DAY_DIMENSIONS = ("year", "month", "month_name", "quarter", "day_name", "is_weekend")
EXPERIENCE_DIMENSIONS = ("city", "category", "country", "experience_name")
BOOKING_DIMENSIONS = ("booking_channel", "booking_status", "payment_status", "supplier_id")


def _booking_sums(
    wh: Warehouse,
    keys: dict[str, Column],
    city: str | None = None,
    category: str | None = None,
    attributes: Sequence[str] = (),
) -> DataFrame:
    """Additive booking measures per experience and ``keys``, with dimension attributes."""
    per_experience = (
        wh.table("fact_bookings")
        .groupBy("experience_id", *[c.alias(k) for k, c in keys.items()])
        .agg(
            row_count("bookings"),
            confirmed_amount().alias("revenue"),
            lost_bookings().alias("lost"),
        )
    )
    experiences = wh.table("dim_experience").filter(choose(city=city, category=category))
    return per_experience.join(experiences.select("experience_id", *attributes), "experience_id")


def _rollup(df: DataFrame, keys: Sequence[str], **names: str) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.sum(c).alias(n) for c, n in names.items()])


def cities(wh: Warehouse) -> DataFrame:
    return wh.table("dim_experience").select("city").distinct().orderBy("city")


def categories(wh: Warehouse) -> DataFrame:
    return wh.table("dim_experience").select("category").distinct().orderBy("category")


def filter_options(wh: Warehouse) -> DataFrame:
    """Both filter lists in one frame: (filter, value)."""
    city = cities(wh).select(F.lit("city").alias("filter"), F.col("city").alias("value"))
    category = categories(wh).select(
        F.lit("category").alias("filter"), F.col("category").alias("value")
    )
    return city.unionByName(category).orderBy("filter", "value")


def kpis(wh: Warehouse, city: str | None = None, category: str | None = None) -> DataFrame:
    """One row, also when nothing matches (then gmv and the rate are NULL)."""
    sums = _booking_sums(wh, {}, city, category)
    lost = F.sum("lost")
    total = F.coalesce(F.sum("bookings"), F.lit(0))
    return sums.agg(
        total.alias("total_bookings"),
        F.sum("revenue").alias("gmv"),
        ratio(lost, F.nullif(total, F.lit(0))).alias("cancellation_rate"),
    )


def repeat_customer_rate(wh: Warehouse) -> DataFrame:
    """Share of booking customers with more than one booking; 0.0 when nobody has booked."""
    repeat = F.when(F.col("is_repeat_booker"), 1.0).otherwise(0.0)
    booked = wh.table("int_customer_activity").filter(F.col("total_bookings") > 0)
    return booked.agg(F.coalesce(F.avg(repeat), F.lit(0.0)).alias("repeat_rate"))


def monthly_trend(
    wh: Warehouse, city: str | None = None, category: str | None = None
) -> DataFrame:
    months = ["year", "month", "month_name"]
    sums = _booking_sums(wh, {"date_day": F.col("date_day")}, city, category)
    per_day = _rollup(sums, ["date_day"], bookings="bookings", revenue="revenue")
    calendar = wh.table("dim_date").select("date_day", *months)
    dated = per_day.join(F.broadcast(calendar), "date_day")  # bounded by the calendar
    return _rollup(dated, months, bookings="bookings", revenue="revenue").orderBy("year", "month")


def city_growth(wh: Warehouse, category: str | None = None) -> DataFrame:
    """Month-over-month change of bookings per destination.

    The window holds one row per city and calendar month.
    """
    sums = _booking_sums(wh, {"date_day": F.col("date_day")}, None, category, ["city"])
    per_day = _rollup(sums, ["city", "date_day"], bookings="bookings")
    calendar = wh.table("dim_date").select("date_day", "year", "month")
    dated = per_day.join(F.broadcast(calendar), "date_day")
    monthly = _rollup(dated, ["city", "year", "month"], bookings="bookings")
    before = F.lag("bookings").over(Window.partitionBy("city").orderBy("year", "month"))
    return monthly.withColumn("previous_bookings", before).withColumn(
        "growth",
        ratio(F.col("bookings") - F.col("previous_bookings"), F.col("previous_bookings")),
    )


def revenue_by_city(wh: Warehouse, category: str | None = None) -> DataFrame:
    sums = _booking_sums(wh, {}, None, category, ["city"])
    return _rollup(sums, ["city"], revenue="revenue").orderBy(F.desc("revenue"), "city")


def funnel(wh: Warehouse) -> DataFrame:
    """Sessions per stage in funnel order; unknown stages last."""
    seen = wh.table("fact_web_events").groupBy("event_type")
    stages = seen.agg(F.countDistinct("session_id").alias("sessions"))
    place = position_in(FUNNEL_STAGES, F.col("event_type"))
    return stages.orderBy(place.asc_nulls_last(), "event_type")


def top_experiences(
    wh: Warehouse, city: str | None = None, category: str | None = None, limit: int = 10
) -> DataFrame:
    keys = ["experience_name", "city", "category"]
    days = wh.table("int_experience_daily_metrics").filter(choose(city=city, category=category))
    taken = F.sum(F.col("total_capacity") - F.col("available_capacity"))
    ranked = days.groupBy(*keys).agg(
        F.sum("total_bookings").alias("bookings"),
        ratio(taken, F.sum("total_capacity")).alias("avg_utilization"),
        F.sum("confirmed_booking_amount").alias("revenue"),
    )
    return ranked.orderBy(F.desc("bookings"), *keys).limit(limit)


def cancellation_by_lead_time(
    wh: Warehouse, city: str | None = None, category: str | None = None
) -> DataFrame:
    bucket = lead_time_bucket(F.col("lead_time_days"))
    sums = _booking_sums(wh, {"lead_time_bucket": bucket}, city, category)
    rolled = _rollup(sums, ["lead_time_bucket"], bookings="total_bookings", lost="lost")
    rate = ratio(F.col("lost"), F.col("total_bookings")).alias("cancellation_rate")
    place = position_in(LEAD_TIME_BUCKETS, F.col("lead_time_bucket"))
    return rolled.select("lead_time_bucket", "total_bookings", rate).orderBy(place)


def channel_mix(wh: Warehouse, city: str | None = None, category: str | None = None) -> DataFrame:
    sums = _booking_sums(wh, {"booking_channel": F.col("booking_channel")}, city, category)
    mix = _rollup(sums, ["booking_channel"], bookings="bookings", revenue="revenue")
    return mix.orderBy(F.desc("bookings"), "booking_channel")


def metric(wh: Warehouse, name: str, by: Sequence[str] = ()) -> DataFrame:
    """A governed metric by any of the booking, experience, calendar or customer dimensions.

    ``total_bookings``, ``gmv`` and ``cancellation_rate`` take booking, experience and calendar
    dimensions; ``repeat_customer_rate`` takes customer attributes.
    """
    if name == "repeat_customer_rate":
        repeat = F.when(F.col("is_repeat_booker"), 1.0).otherwise(0.0)
        booked = wh.table("int_customer_activity").filter(F.col("total_bookings") > 0)
        return booked.groupBy(*by).agg(F.coalesce(F.avg(repeat), F.lit(0.0)).alias(name))
    values = {
        "total_bookings": F.coalesce(F.sum("bookings"), F.lit(0)),
        "gmv": F.sum("revenue"),
        "cancellation_rate": ratio(F.sum("lost"), F.sum("bookings")),
    }
    keys = {d: F.col(d) for d in by if d in BOOKING_DIMENSIONS}
    attributes = [d for d in by if d in EXPERIENCE_DIMENSIONS]
    days = [d for d in by if d in DAY_DIMENSIONS]
    unknown = set(by) - set(keys) - set(attributes) - set(days)
    if name not in values or unknown:
        raise ValueError(f"unknown metric or dimension: {name} by {sorted(unknown)}")
    if days:
        keys["date_day"] = F.col("date_day")
    sums = _booking_sums(wh, keys, attributes=attributes)
    if days:
        calendar = wh.table("dim_date").select("date_day", *days)
        sums = sums.join(F.broadcast(calendar), "date_day")
    return sums.groupBy(*by).agg(values[name].alias(name))
