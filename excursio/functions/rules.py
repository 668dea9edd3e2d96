"""Business rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from excursio.functions.calendar import is_weekend
from excursio.functions.scalars import clamp, lookup

# The marketplace's published rule tables.
SEASON_BY_MONTH = {
    1: 0.80, 2: 0.80, 3: 0.90, 4: 1.00, 5: 1.05, 6: 1.20,
    7: 1.30, 8: 1.30, 9: 1.05, 10: 0.95, 11: 0.90, 12: 1.15,
}
WEEKEND_DEMAND = 1.35
WEEKEND_PRICE = 1.15
DEMAND_SCALE = 1.0
BASE_CANCELLATION = 0.10
RISK_FLOOR, RISK_CEILING = 0.02, 0.85
TIME_SLOTS = ("09:00", "11:00", "13:00", "15:00", "17:00")
SLOTS_BY_CATEGORY = {
    "Theme Park": 4, "Attraction": 3, "Museum": 3, "Cruise": 2,
    "Guided Tour": 2, "Food & Drink": 2, "Show": 2, "Adventure": 1,
}
DEFAULT_SLOTS = 2
RISKY_CATEGORIES = ("Adventure", "Cruise")
STEADY_CATEGORIES = ("Museum", "Attraction")
LEAD_TIME_BUCKETS = ("<3d", "3-14d", "14-60d", ">60d")
BOOKING_WINDOWS = ("short", "medium", "long")
NEW_CUSTOMER_DAYS = 90
NEW_CUSTOMER_SEGMENTS = ("New", "Repeat")


def season(day: Column) -> Column:
    return lookup(SEASON_BY_MONTH, F.month(day), 1.0)


def weekend_factor(day: Column, factor: float) -> Column:
    return F.when(is_weekend(day), factor).otherwise(1.0)


def slot_count(category: Column) -> Column:
    return F.least(lookup(SLOTS_BY_CATEGORY, category, DEFAULT_SLOTS), F.lit(len(TIME_SLOTS)))


def slots(category: Column) -> Column:
    """The first slots of the day, as many as the category runs."""
    return F.slice(F.array(*[F.lit(s) for s in TIME_SLOTS]), 1, slot_count(category))


def slot_capacity(capacity: Column, category: Column) -> Column:
    """Capacity shared evenly over the slots, at least 1."""
    share = F.floor(capacity / slot_count(category)).cast("int")
    return F.greatest(F.lit(1), share)


def calendar_price(base_price: Column, day: Column) -> Column:
    return F.round(base_price * season(day) * weekend_factor(day, WEEKEND_PRICE), 2)


def price_elasticity(price: Column, base_price: Column) -> Column:
    """Demand falls with price relative to base, never below 0.3; 1.0 without a base price."""
    relative = F.try_divide(price.cast("double"), base_price.cast("double"))
    return F.when(base_price <= 0, 1.0).otherwise(F.greatest(F.lit(0.3), 1.4 - 0.6 * relative))


def rating_factor(rating: Column) -> Column:
    return F.when(rating >= 4.5, 1.15).when(rating < 4.0, 0.85).otherwise(1.0)


def expected_demand(
    popularity: Column,
    day: Column,
    price: Column,
    base_price: Column,
    rating: Column,
    scale: float = DEMAND_SCALE,
) -> Column:
    return (
        popularity
        * season(day)
        * weekend_factor(day, WEEKEND_DEMAND)
        * price_elasticity(price, base_price)
        * rating_factor(rating)
        * F.lit(scale)
    )


def cancellation_multiplier(
    lead_time_days: Column,
    discount_pct: Column,
    channel: Column,
    category: Column,
    prior_cancellations: Column,
) -> Column:
    lead = (
        F.when(lead_time_days > 60, 1.6)
        .when(lead_time_days >= 14, 1.2)
        .when(lead_time_days < 3, 0.5)
        .otherwise(1.0)
    )
    discount = F.when(discount_pct > 0.20, 1.3).otherwise(1.0)
    partner = F.when(channel == "PARTNER", 1.25).otherwise(1.0)
    kind = (
        F.when(category.isin(*RISKY_CATEGORIES), 1.3)
        .when(category.isin(*STEADY_CATEGORIES), 0.85)
        .otherwise(1.0)
    )
    history = (
        F.when(prior_cancellations == 1, 1.4).when(prior_cancellations >= 2, 1.9).otherwise(1.0)
    )
    return lead * discount * partner * kind * history


def cancellation_risk(multiplier: Column) -> Column:
    return clamp(F.lit(BASE_CANCELLATION) * multiplier, RISK_FLOOR, RISK_CEILING)


def lead_time_bucket(lead_time_days: Column) -> Column:
    """Reporting buckets; a missing lead time falls in the last one."""
    return (
        F.when(lead_time_days < 3, LEAD_TIME_BUCKETS[0])
        .when(lead_time_days < 14, LEAD_TIME_BUCKETS[1])
        .when(lead_time_days < 60, LEAD_TIME_BUCKETS[2])
        .otherwise(LEAD_TIME_BUCKETS[3])
    )


def booking_window(lead_time_days: Column) -> Column:
    """Planning horizon: 1-7, 8-30 and 31-120 days; NULL outside."""
    return (
        F.when(lead_time_days.between(1, 7), BOOKING_WINDOWS[0])
        .when(lead_time_days.between(8, 30), BOOKING_WINDOWS[1])
        .when(lead_time_days.between(31, 120), BOOKING_WINDOWS[2])
    )


def booking_amount(ticket_price: Column, guests: Column, discount_amount: Column) -> Column:
    return F.greatest(F.lit(0.0), F.round(ticket_price * guests - discount_amount, 2))


def is_late(booking_timestamp: Column, experience_date: Column) -> Column:
    """Booked on or after the day of the visit."""
    return booking_timestamp >= experience_date.cast("timestamp_ntz")
