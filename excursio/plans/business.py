"""Business-rule reports: prices, demand, cancellation risk, inventory, sessions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from excursio.functions import rules
from excursio.functions.calendar import days_between, minutes_between
from excursio.functions.scalars import position_in
from excursio.operators.joins import matched_once, unmatched_between
from excursio.operators.measures import count_where, ratio, row_count
from excursio.operators.ordered import previous_values, running_total
from excursio.schemas import FUNNEL_STAGES, LOST_STATUSES
from excursio.shared import write_shared
from excursio.warehouse import Warehouse

AMOUNT_TOLERANCE = 0.005


def price_calendar(experiences: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Opening inventory of active experiences for each day of [start, end) and slot.

    Days and slots are exploded in place, so no join or shuffle is needed.
    """
    day, category = F.col("experience_date"), F.col("category")
    capacity = rules.slot_capacity(F.col("capacity"), category)
    days = experiences.filter("active_flag").select(
        "experience_id",
        "base_price",
        "category",
        "capacity",
        F.explode(days_between(start, end)).alias("experience_date"),
    )
    return days.select(
        "experience_id",
        "experience_date",
        F.explode(rules.slots(category)).alias("time_slot"),
        capacity.alias("total_capacity"),
        capacity.alias("available_capacity"),
        rules.calendar_price(F.col("base_price"), day).alias("price"),
    )


def expected_demand(wh: Warehouse, scale: float = rules.DEMAND_SCALE) -> DataFrame:
    """Rule-based demand per (experience, day) next to what was booked.

    Popularity is the experience's mean daily bookings relative to the overall mean.
    """
    needed = ["experience_id", "experience_date", "total_bookings", "avg_price", "base_price", "rating"]
    days = wh.settled(wh.table("experience_days").select(*needed), "demand-days", "experience_days")
    means = days.groupBy("experience_id").agg(
        F.avg("total_bookings").alias("own_mean"), F.sum("total_bookings").alias("total"), F.count("total_bookings").alias("n")
    )
    overall = means.agg(F.sum("total") / F.sum("n")).scalar()
    days = days.join(means.select("experience_id", "own_mean"), "experience_id")
    popularity = ratio(F.col("own_mean"), overall)
    demand = rules.expected_demand(
        popularity,
        F.col("experience_date"),
        F.col("avg_price"),
        F.col("base_price"),
        F.col("rating"),
        scale,
    )
    return days.select(
        "experience_id",
        "experience_date",
        "total_bookings",
        popularity.alias("popularity"),
        demand.alias("expected_bookings"),
    )


def prior_cancellations(wh: Warehouse, chunks: int | None = None) -> DataFrame:
    """Valid bookings with the customer's number of earlier cancelled or refunded ones."""
    bookings = wh.table("int_booking_details").select(
        "booking_id",
        "customer_id",
        "booking_timestamp",
        "lead_time_days",
        "discount_pct",
        "booking_channel",
        F.col("experience_category").alias("category"),
        "booking_status",
    )
    lost = F.coalesce(F.col("booking_status").isin(*LOST_STATUSES), F.lit(False)).cast("bigint")
    return running_total(
        bookings,
        "customer_id",
        ["booking_timestamp", "booking_id"],
        lost,
        "prior_cancellations",
        chunks,
    )


def cancellation_counts(wh: Warehouse) -> DataFrame:
    """Cancelled or refunded bookings per known customer."""
    lost = wh.table("fact_bookings").filter(
        F.col("booking_status").isin(*LOST_STATUSES) & F.col("customer_id").isNotNull()
    )
    return lost.groupBy("customer_id").agg(row_count("cancellation_count"))


def with_cancellation_counts(wh: Warehouse, df: DataFrame) -> DataFrame:
    """Add the customer's cancellation count so far, 0 when there is none."""
    joined = df.join(cancellation_counts(wh), "customer_id", "left")
    return joined.withColumn("cancellation_count", F.coalesce("cancellation_count", F.lit(0)))


def cancellation_risk(wh: Warehouse) -> DataFrame:
    multiplier = rules.cancellation_multiplier(
        F.col("lead_time_days"),
        F.col("discount_pct"),
        F.col("booking_channel"),
        F.col("category"),
        F.col("prior_cancellations"),
    )
    return prior_cancellations(wh).select(
        "booking_id",
        "customer_id",
        "lead_time_days",
        "booking_status",
        "prior_cancellations",
        multiplier.alias("multiplier"),
        rules.cancellation_risk(multiplier).alias("risk"),
    )


def risk_calibration(wh: Warehouse) -> DataFrame:
    """Predicted against actual cancellation share per lead-time bucket."""
    cancelled = F.when(F.col("booking_status").isin(*LOST_STATUSES), 1.0).otherwise(0.0)
    bucket = rules.lead_time_bucket(F.col("lead_time_days")).alias("lead_time_bucket")
    return (
        cancellation_risk(wh)
        .groupBy(bucket)
        .agg(
            row_count("bookings"),
            F.avg("risk").alias("predicted_rate"),
            F.avg(cancelled).alias("actual_rate"),
        )
    )


def reconcile_inventory(wh: Warehouse) -> DataFrame:
    """Capacity left per (experience, day) according to the bookings, against what is stored."""
    days = wh.table("experience_days")
    left = F.greatest(F.lit(0), F.col("total_capacity") - F.col("total_guests"))
    return days.select(
        "experience_id",
        "experience_date",
        "total_capacity",
        F.col("total_guests").alias("booked_guests"),
        left.alias("expected_available"),
        F.col("available_capacity").alias("stored_available"),
        (F.col("available_capacity") - left).alias("difference"),
    )


def over_capacity(wh: Warehouse) -> DataFrame:
    booked = F.col("booked_guests") > F.col("total_capacity")
    return reconcile_inventory(wh).filter(booked)


def near_capacity(wh: Warehouse, threshold: float = 0.9) -> DataFrame:
    """Experience days whose utilization has reached ``threshold``."""
    return (
        wh.table("int_experience_daily_metrics")
        .filter(F.col("utilization_rate") >= threshold)
        .select("experience_id", "experience_date", "utilization_rate")
    )


def amount_mismatches(wh: Warehouse) -> DataFrame:
    """Bookings whose amount is not price x guests - discount."""
    expected = rules.booking_amount(
        F.col("ticket_price"), F.col("number_of_guests"), F.col("discount_amount")
    )
    return (
        wh.table("stg_bookings")
        .select("booking_id", "booking_amount", expected.alias("expected_amount"))
        .filter(F.abs(F.col("booking_amount") - F.col("expected_amount")) > AMOUNT_TOLERANCE)
    )


def funnel_dropoff(wh: Warehouse) -> DataFrame:
    """Sessions per known stage, conversion from the stage before and from the first stage."""
    stage = position_in(FUNNEL_STAGES, F.col("event_type"))
    known = wh.table("fact_web_events").withColumn("stage", stage).filter("stage is not null")
    seen = known.groupBy("stage", "event_type").agg(
        F.countDistinct("session_id").alias("sessions")
    )
    order = Window.partitionBy(F.lit(0)).orderBy("stage")  # at most one row per stage
    sessions = F.col("sessions")
    return seen.select(
        "stage",
        "event_type",
        "sessions",
        ratio(sessions, F.lag("sessions").over(order)).alias("step_conversion"),
        ratio(sessions, F.first("sessions").over(order)).alias("overall_conversion"),
    )


def session_summary(wh: Warehouse) -> DataFrame:
    stage = position_in(FUNNEL_STAGES, F.col("event_type"))
    first, last = F.min("event_timestamp"), F.max("event_timestamp")
    return (
        wh.table("stg_web_events")
        .groupBy("session_id")
        .agg(
            first.alias("first_event_at"),
            last.alias("last_event_at"),
            row_count("events"),
            F.max(stage).alias("deepest_stage"),
            (F.count_if(F.col("event_type") == "PURCHASE") > 0).alias("converted"),
        )
    )


def browsing_session_length(wh: Warehouse) -> DataFrame:
    """Mean number of events of sessions without a purchase."""
    browsing = session_summary(wh).filter("not converted")
    return browsing.agg(row_count("sessions"), F.avg("events").alias("mean_events"))


def session_steps(wh: Warehouse, chunks: int | None = None) -> DataFrame:
    """Events with the time and stage of the event before in the session."""
    events = wh.table("stg_web_events").select(
        "event_id",
        "session_id",
        "event_timestamp",
        "event_type",
        position_in(FUNNEL_STAGES, F.col("event_type")).alias("stage"),
    )
    return previous_values(
        events,
        "session_id",
        ["event_timestamp", "event_id"],
        {"previous_timestamp": "event_timestamp", "previous_stage": "stage"},
        chunks,
    )


def session_order_violations(wh: Warehouse, chunks: int | None = None) -> DataFrame:
    """Events that do not come strictly later than, or fall behind the stage of, the previous."""
    not_later = F.col("event_timestamp") <= F.col("previous_timestamp")
    backwards = F.col("stage") < F.col("previous_stage")
    flags = {"not_later": not_later, "stage_went_back": backwards}
    steps = session_steps(wh, chunks).select(
        "session_id",
        "event_id",
        "event_timestamp",
        "event_type",
        *[F.coalesce(flag, F.lit(False)).alias(name) for name, flag in flags.items()],
    )
    return steps.filter("not_later or stage_went_back")


def session_gaps(wh: Warehouse, chunks: int | None = None) -> DataFrame:
    """Minutes since the previous event of the session."""
    gap = minutes_between("previous_timestamp", "event_timestamp")
    return (
        session_steps(wh, chunks)
        .filter("previous_timestamp is not null")
        .select("session_id", "event_id", "event_type", gap.alias("gap_minutes"))
    )


def segment_violations(wh: Warehouse) -> DataFrame:
    """Customers younger than 90 days in a segment reserved for established ones."""
    young = F.col("tenure_days") < rules.NEW_CUSTOMER_DAYS
    allowed = F.col("customer_segment").isin(*rules.NEW_CUSTOMER_SEGMENTS)
    violating = wh.table("dim_customer").filter(young & ~allowed)
    return violating.select("customer_id", "customer_segment", "tenure_days")


def late_bookings(wh: Warehouse) -> DataFrame:
    late = rules.is_late(F.col("booking_timestamp"), F.col("experience_date"))
    rows = wh.table("stg_bookings").filter(late)
    return rows.select("booking_id", "booking_timestamp", "experience_date")


def lead_time_windows(wh: Warehouse) -> DataFrame:
    """Bookings per planning window, with the lead time derived from the two dates."""
    derived = F.datediff(F.col("experience_date"), F.to_date("booking_timestamp"))
    window = rules.booking_window(F.col("lead_time_days")).alias("booking_window")
    agrees = F.col("lead_time_days") == derived
    rows = wh.table("stg_bookings").groupBy(window)
    return rows.agg(row_count("bookings"), count_where(agrees).alias("lead_time_as_derived"))


def bookings_before_signup(wh: Warehouse) -> DataFrame:
    customers = wh.table("stg_customers").select("customer_id", "signup_date")
    early = F.to_date("booking_timestamp") < F.col("signup_date")
    joined = wh.table("stg_bookings").join(customers, "customer_id").filter(early)
    return joined.select("booking_id", "customer_id", "booking_timestamp", "signup_date")


def bookings_without_inventory(wh: Warehouse) -> DataFrame:
    """Bookings on a day their experience has no inventory for."""
    keys = ["experience_id", "experience_date"]
    open_days = wh.table("stg_availability").select(*keys).distinct()
    missing = wh.table("stg_bookings").join(open_days, keys, "left_anti")
    return missing.select("booking_id", *keys)


def unmatched_purchases(wh: Warehouse) -> tuple[DataFrame, DataFrame]:
    """(purchases without a booking, bookings without a purchase) on customer, experience, time."""
    keys = ["customer_id", "experience_id", "booking_timestamp"]
    purchases = (
        wh.table("stg_web_events")
        .filter(F.col("event_type") == "PURCHASE")
        .withColumnRenamed("event_timestamp", "booking_timestamp")
        .select("event_id", *keys)
    )
    bookings = wh.table("stg_bookings").select("booking_id", *keys)
    return unmatched_between(purchases, bookings, keys)


def purchase_reconciliation(wh: Warehouse) -> DataFrame:
    """One row: purchases, bookings, what is unmatched on each side, whether counts agree.

    Both sides are counted per customer, experience and time in one grouping.
    """
    keys = ["customer_id", "experience_id", "booking_timestamp"]
    bought = wh.table("stg_web_events").filter(F.col("event_type") == "PURCHASE")
    bought = bought.withColumnRenamed("event_timestamp", "booking_timestamp").select(*keys, F.lit(True).alias("bought"))
    booked = wh.table("stg_bookings").select(*keys, F.lit(False).alias("bought"))
    sides = bought.unionByName(booked).groupBy(*keys).agg(
        F.count_if("bought").alias("purchases"), F.count_if(~F.col("bought")).alias("bookings")
    )
    unknown = F.col(keys[0]).isNull() | F.col(keys[1]).isNull() | F.col(keys[2]).isNull()

    def alone(side: str, other: str) -> Column:
        return F.sum(F.when(unknown | (F.col(other) == 0), F.col(side)).otherwise(0))

    def total(rows: Column) -> Column:
        return F.coalesce(rows, F.lit(0))

    return sides.agg(
        total(F.sum("purchases")).alias("purchases"),
        total(F.sum("bookings")).alias("bookings"),
        total(alone("purchases", "bookings")).alias("purchases_without_booking"),
        total(alone("bookings", "purchases")).alias("bookings_without_purchase"),
        (total(F.sum("purchases")) == total(F.sum("bookings"))).alias("counts_agree"),
    )


def purchase_matches(purchases: DataFrame, bookings: DataFrame, within_minutes: int = 60) -> DataFrame:
    """Each purchase with at most one booking: both ids, or one of them alone, and ``status``.

    Purchases have ``event_id`` and ``event_timestamp``, bookings ``booking_id`` and ``booking_timestamp``;
    both have a customer and an experience. Ids must be unique.
    """
    keys = ["customer_id", "experience_id"]
    pairs = matched_once(
        purchases, bookings, keys, "event_id", "booking_id", "event_timestamp", "booking_timestamp", within_minutes
    )
    pairs = write_shared(pairs, "matches")
    lone_purchases = purchases.select("event_id").join(pairs.select("event_id"), "event_id", "left_anti")
    lone_bookings = bookings.select("booking_id").join(pairs.select("booking_id"), "booking_id", "left_anti")
    return (
        pairs.withColumn("status", F.lit("matched"))
        .unionByName(lone_purchases.withColumn("status", F.lit("purchase only")), allowMissingColumns=True)
        .unionByName(lone_bookings.withColumn("status", F.lit("booking only")), allowMissingColumns=True)
    )
