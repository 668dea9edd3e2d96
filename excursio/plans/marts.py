"""Marts: four dimensions and three facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from excursio.functions.calendar import date_spine, day_of_week, is_weekend, tenure_days
from excursio.plans.intermediate import utilization
from excursio.warehouse import Warehouse


def dim_customer(wh: Warehouse) -> DataFrame:
    return wh.table("stg_customers").select(
        "customer_id",
        "signup_date",
        "country",
        "preferred_language",
        "acquisition_channel",
        "customer_segment",
        tenure_days("signup_date", wh.as_of()).alias("tenure_days"),
    )


def dim_supplier(wh: Warehouse) -> DataFrame:
    return wh.table("stg_suppliers").select(
        "*", tenure_days("contract_start_date", wh.as_of()).alias("contract_tenure_days")
    )


def dim_experience(wh: Warehouse) -> DataFrame:
    return wh.table("stg_experiences")


def dim_date(wh: Warehouse) -> DataFrame:
    return calendar_rows(date_spine(wh.spark, *wh.calendar))


def calendar_rows(spine: DataFrame) -> DataFrame:
    """Calendar attributes of each ``date_day``."""
    day = F.col("date_day")
    return spine.select(
        day,
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.day(day).alias("day_of_month"),
        day_of_week(day).alias("day_of_week"),
        F.dayname(day).alias("day_name"),
        F.monthname(day).alias("month_name"),
        F.quarter(day).alias("quarter"),
        F.weekofyear(day).alias("week_of_year"),
        is_weekend(day).alias("is_weekend"),
    )


def fact_bookings(wh: Warehouse) -> DataFrame:
    """One row per valid booking; ``date_day`` is the day of the visit."""
    return wh.table("int_booking_details").select(
        "booking_id",
        "customer_id",
        "experience_id",
        "supplier_id",
        F.col("experience_date").cast("date").alias("date_day"),
        "booking_timestamp",
        "number_of_guests",
        "ticket_price",
        "discount_amount",
        "booking_amount",
        "lead_time_days",
        "discount_pct",
        "booking_status",
        "payment_status",
        "booking_channel",
        "currency",
    )


def fact_web_events(wh: Warehouse) -> DataFrame:
    return wh.table("stg_web_events").select(
        "event_id",
        "customer_id",
        "session_id",
        "experience_id",
        F.to_date("event_timestamp").alias("date_day"),
        "event_timestamp",
        "event_type",
        "device_type",
        "traffic_source",
        "city_searched",
    )


def fact_experience_availability(wh: Warehouse) -> DataFrame:
    taken = F.col("total_capacity") - F.col("available_capacity")
    return wh.table("stg_availability").select(
        "experience_id",
        F.col("experience_date").cast("date").alias("date_day"),
        "time_slot",
        "total_capacity",
        "available_capacity",
        "price",
        utilization(taken, F.col("total_capacity")).alias("utilization_rate"),
    )


MODELS = {
    "dim_customer": dim_customer,
    "dim_supplier": dim_supplier,
    "dim_experience": dim_experience,
    "dim_date": dim_date,
    "fact_bookings": fact_bookings,
    "fact_web_events": fact_web_events,
    "fact_experience_availability": fact_experience_availability,
}
