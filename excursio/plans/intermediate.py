"""Intermediate models: enriched bookings, the orphan queue, customer and daily roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from excursio.operators.measures import confirmed_amount, ratio, row_count, with_status
from excursio.schemas import ORPHAN_REASON, columns
from excursio.warehouse import Warehouse


def int_booking_details(wh: Warehouse) -> DataFrame:
    """Bookings with their experience and supplier; bookings lacking either fall out.

    The two catalog tables are joined with each other first, so the bookings are shuffled for
    one join instead of two.
    """
    suppliers = wh.table("stg_suppliers").select(
        "supplier_id", "supplier_name", "supplier_type", "commission_rate"
    )
    catalog = (
        wh.table("stg_experiences")
        .select(
            "experience_id",
            "experience_name",
            F.col("city").alias("experience_city"),
            F.col("country").alias("experience_country"),
            F.col("category").alias("experience_category"),
            F.col("base_price").alias("experience_base_price"),
            F.col("capacity").alias("experience_capacity"),
            "supplier_id",
        )
        .join(suppliers, "supplier_id")
    )
    attributes = [c for c in catalog.columns if c not in ("experience_id", "supplier_id")]
    supplier = [c for c in suppliers.columns if c != "supplier_id"]
    experience = [c for c in attributes if c not in supplier]
    enriched = wh.table("stg_bookings").join(catalog, "experience_id")
    return enriched.select(*columns("bookings"), *experience, "supplier_id", *supplier)


def int_orphaned_bookings(wh: Warehouse) -> DataFrame:
    """Bookings whose experience is not in the catalog (NULL included)."""
    known = wh.table("stg_experiences").select("experience_id")
    orphans = wh.table("stg_bookings").join(known, "experience_id", "left_anti")
    return orphans.select(
        "booking_id",
        "customer_id",
        "experience_id",
        "booking_timestamp",
        "booking_amount",
        "booking_status",
        F.lit(ORPHAN_REASON).alias("orphan_reason"),
        wh.flagged_at().cast("timestamp_ntz").alias("flagged_at"),
    )


def int_customer_activity(wh: Warehouse) -> DataFrame:
    """One row per customer; both sides are aggregated before they meet, so nothing fans out."""
    bookings = (
        wh.table("int_booking_details")
        .filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(
            row_count("total_bookings"),
            with_status("CONFIRMED").alias("confirmed_bookings"),
            with_status("CANCELLED").alias("cancelled_bookings"),
            with_status("REFUNDED").alias("refunded_bookings"),
            F.sum("booking_amount").alias("lifetime_booking_amount"),
            confirmed_amount().alias("lifetime_confirmed_amount"),
            F.min("booking_timestamp").alias("first_booking_at"),
            F.max("booking_timestamp").alias("last_booking_at"),
        )
    )
    sessions = _session_activity(wh.table("stg_web_events"))
    counts = [
        "total_bookings",
        "confirmed_bookings",
        "cancelled_bookings",
        "refunded_bookings",
        "lifetime_booking_amount",
        "lifetime_confirmed_amount",
        "total_sessions",
        "search_events",
        "purchase_events",
    ]
    joined = (
        wh.table("stg_customers")
        .join(bookings, "customer_id", "left")
        .join(sessions, "customer_id", "left")
    )
    return joined.select(
        "customer_id",
        "signup_date",
        "country",
        "acquisition_channel",
        "customer_segment",
        "first_booking_at",
        "last_booking_at",
        "first_event_at",
        "last_event_at",
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in counts],
        F.coalesce(F.col("total_bookings") > 1, F.lit(False)).alias("is_repeat_booker"),
    )


def _session_activity(events: DataFrame) -> DataFrame:
    """Per customer, via one row per (customer, session).

    A distinct count next to plain aggregates makes Spark carry the session id through every
    aggregate. Rolling up to sessions first gives the same numbers with ordinary sums, and a
    customer with a third of all events is spread over that customer's sessions.
    """
    per_session = (
        events.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id", "session_id")
        .agg(
            F.count_if(F.col("event_type") == "SEARCH").alias("search_events"),
            F.count_if(F.col("event_type") == "PURCHASE").alias("purchase_events"),
            F.min("event_timestamp").alias("first_event_at"),
            F.max("event_timestamp").alias("last_event_at"),
        )
    )
    return per_session.groupBy("customer_id").agg(
        F.count("session_id").alias("total_sessions"),
        F.sum("search_events").alias("search_events"),
        F.sum("purchase_events").alias("purchase_events"),
        F.min("first_event_at").alias("first_event_at"),
        F.max("last_event_at").alias("last_event_at"),
    )


def experience_days(wh: Warehouse) -> DataFrame:
    """Everything known per (experience, day) with inventory; quiet days have no bookings.

    Inventory drives: a booking on a day without inventory does not appear. Average price and
    the experience's own attributes ride along, so that the feature models need not group the
    inventory a second time or join the catalog again. Both sides are grouped on the same pair
    of keys, so the left join needs no further shuffle.
    """
    keys = ["experience_id", "experience_date"]
    inventory = (
        wh.table("stg_availability")
        .groupBy(*keys)
        .agg(
            F.sum("total_capacity").alias("total_capacity"),
            F.sum("available_capacity").alias("available_capacity"),
            F.avg("price").alias("avg_price"),
        )
    )
    demand = (
        wh.table("int_booking_details")
        .groupBy(*keys)
        .agg(
            row_count("total_bookings"),
            with_status("CONFIRMED").alias("confirmed_bookings"),
            with_status("CANCELLED").alias("cancelled_bookings"),
            with_status("REFUNDED").alias("refunded_bookings"),
            F.sum("number_of_guests").alias("total_guests"),
            F.sum("booking_amount").alias("total_booking_amount"),
            confirmed_amount().alias("confirmed_booking_amount"),
            F.avg("lead_time_days").alias("avg_lead_time_days"),
        )
    )
    experiences = wh.table("stg_experiences").select(
        "experience_id", "experience_name", "city", "category", "capacity", "rating", "base_price"
    )
    zeroed = [
        "total_bookings",
        "confirmed_bookings",
        "cancelled_bookings",
        "refunded_bookings",
        "total_guests",
        "total_booking_amount",
        "confirmed_booking_amount",
    ]
    days = inventory.join(demand, keys, "left").join(experiences, "experience_id")
    taken = F.col("total_capacity") - F.col("available_capacity")
    cancelled = ratio(F.col("cancelled_bookings"), F.col("total_bookings"))
    return days.select(
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) if c in zeroed else c for c in days.columns],
        utilization(taken, F.col("total_capacity")).alias("utilization_rate"),
        F.round(cancelled, 4).alias("cancellation_rate"),
    )


def utilization(taken, capacity):
    """Rounded share of capacity taken; NULL without positive capacity."""
    return F.when(capacity > 0, F.round(ratio(taken, capacity), 4))


DAILY_METRIC_COLUMNS = [
    "experience_id",
    "experience_name",
    "city",
    "category",
    "avg_lead_time_days",
    "total_capacity",
    "available_capacity",
    "experience_date",
    "total_bookings",
    "confirmed_bookings",
    "cancelled_bookings",
    "refunded_bookings",
    "total_guests",
    "total_booking_amount",
    "confirmed_booking_amount",
    "utilization_rate",
    "cancellation_rate",
]


def int_experience_daily_metrics(wh: Warehouse) -> DataFrame:
    return wh.table("experience_days").select(*DAILY_METRIC_COLUMNS)


MODELS = {
    "int_booking_details": int_booking_details,
    "int_orphaned_bookings": int_orphaned_bookings,
    "int_customer_activity": int_customer_activity,
    "int_experience_daily_metrics": int_experience_daily_metrics,
}

# Not a published model: the wide daily table that the daily metrics and the features share.
HELPERS = {"experience_days": experience_days}
