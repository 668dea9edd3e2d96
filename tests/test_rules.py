"""Business rules, at their boundaries and by direction."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from excursio.functions import calendar, rules, scalars


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()[0]


@pytest.mark.parametrize(
    "price, base, expected",
    [(100, 100, 0.8), (200, 100, 0.3), (50, 100, 1.1), (10000, 10, 0.3), (50, 0, 1.0), (50, -1, 1.0)],
)
def test_price_elasticity(spark, price, base, expected):
    got = value(spark, rules.price_elasticity(F.lit(price), F.lit(base)))
    assert got == pytest.approx(expected)


@pytest.mark.parametrize(
    "rating, expected",
    [(1.0, 0.85), (3.9, 0.85), (4.0, 1.0), (4.4, 1.0), (4.49, 1.0), (4.5, 1.15), (5.0, 1.15)],
)
def test_rating_factor(spark, rating, expected):
    assert value(spark, rules.rating_factor(F.lit(rating))) == expected


def multiplier(spark, **changes):
    row = {"lead": 10, "discount": 0.0, "channel": "WEB", "category": "Show", "prior": 0}
    row.update(changes)
    return value(spark, rules.cancellation_multiplier(*[F.lit(v) for v in row.values()]))


@pytest.mark.parametrize(
    "change, factor",
    [
        ({}, 1.0),
        ({"lead": 90}, 1.6),
        ({"lead": 61}, 1.6),
        ({"lead": 60}, 1.2),
        ({"lead": 14}, 1.2),
        ({"lead": 13}, 1.0),
        ({"lead": 3}, 1.0),
        ({"lead": 2}, 0.5),
        ({"discount": 0.25}, 1.3),
        ({"discount": 0.20}, 1.0),
        ({"channel": "PARTNER"}, 1.25),
        ({"category": "Adventure"}, 1.3),
        ({"category": "Cruise"}, 1.3),
        ({"category": "Museum"}, 0.85),
        ({"category": "Attraction"}, 0.85),
        ({"prior": 1}, 1.4),
        ({"prior": 2}, 1.9),
        ({"prior": 9}, 1.9),
        ({"lead": 90, "channel": "PARTNER", "prior": 2}, 1.6 * 1.25 * 1.9),
    ],
)
def test_cancellation_multiplier(spark, change, factor):
    assert multiplier(spark, **change) == pytest.approx(factor)


def test_risk_is_clamped(spark):
    risks = [value(spark, rules.cancellation_risk(F.lit(m))) for m in (0.01, 1.0, 100.0)]
    assert risks == pytest.approx([0.02, 0.10, 0.85])


@pytest.mark.parametrize(
    "days, bucket, window",
    [
        (0, "<3d", None),
        (2, "<3d", "short"),
        (3, "3-14d", "short"),
        (8, "3-14d", "medium"),
        (13, "3-14d", "medium"),
        (14, "14-60d", "medium"),
        (59, "14-60d", "long"),
        (60, ">60d", "long"),
        (120, ">60d", "long"),
        (121, ">60d", None),
    ],
)
def test_lead_time_buckets(spark, days, bucket, window):
    assert value(spark, rules.lead_time_bucket(F.lit(days))) == bucket
    assert value(spark, rules.booking_window(F.lit(days))) == window


def test_prices_follow_season_and_weekend(spark):
    def price(day):
        return value(spark, rules.calendar_price(F.lit(100.0), F.lit(day)))

    assert price(dt.date(2026, 7, 1)) == 130.0  # Wednesday
    assert price(dt.date(2026, 7, 4)) == 149.5  # Saturday
    assert price(dt.date(2026, 1, 4)) == 92.0  # Sunday


def test_slots_and_capacity(spark):
    assert value(spark, rules.slots(F.lit("Adventure"))) == ["09:00"]
    assert value(spark, rules.slots(F.lit("Theme Park"))) == ["09:00", "11:00", "13:00", "15:00"]
    assert len(value(spark, rules.slots(F.lit("Unknown")))) == 2
    assert value(spark, rules.slot_capacity(F.lit(10), F.lit("Museum"))) == 3
    assert value(spark, rules.slot_capacity(F.lit(1), F.lit("Museum"))) == 1


def test_booking_amount_never_negative(spark):
    amount = rules.booking_amount(F.lit(10.0), F.lit(2), F.lit(50.0))
    assert value(spark, amount) == 0.0


def test_ids_keep_long_numbers(spark):
    assert value(spark, scalars.make_id("EXP", F.lit(7), 6)) == "EXP000007"
    assert value(spark, scalars.make_id("EXP", F.lit(12345678), 6)) == "EXP12345678"
    assert value(spark, scalars.id_number(F.lit("B90001"), 1)) == 90001
    assert value(spark, scalars.id_number(F.lit("B9x"), 1)) is None


def test_lookups(spark):
    names = {"a": "x", "b": "y"}
    known, unknown = (scalars.lookup(names, F.lit(k), "z") for k in ("b", "c"))
    assert (value(spark, known), value(spark, unknown)) == ("y", "z")
    assert value(spark, scalars.position_in(["a", "b"], F.lit("b"))) == 2
    assert value(spark, scalars.position_in(["a", "b"], F.lit("z"))) is None


def test_calendar_functions(spark):
    saturday = F.lit(dt.date(2026, 9, 12))
    assert value(spark, calendar.day_of_week(saturday)) == 6
    assert value(spark, calendar.is_weekend(saturday)) is True
    assert value(spark, calendar.month_label(F.lit("September"), F.lit(2026))) == "Sep 2026"
    spine = calendar.date_spine(spark, dt.date(2025, 5, 1), dt.date(2028, 1, 1))
    first, last, n = spine.agg(F.min("date_day"), F.max("date_day"), F.count("date_day")).first()
    assert (first, last, n) == (dt.date(2025, 5, 1), dt.date(2027, 12, 31), 975)
    assert calendar.date_spine(spark, dt.date(2025, 5, 1), dt.date(2025, 5, 1)).count() == 0
    early, late = F.lit(dt.datetime(2026, 1, 1, 10)), F.lit(dt.datetime(2026, 1, 1, 10, 1, 30))
    assert value(spark, calendar.minutes_between(early, late)) == 1.5


def test_column_wide_helpers(spark):
    df = spark.sql("select cast(1.5 as decimal(5,2)) as ` Amount`, true as flag, null as gone")
    plain = scalars.decimals_to_double(scalars.lower_names(df))
    assert dict(plain.dtypes)["amount"] == "double"
    assert scalars.booleans_to_int(plain, ["flag"]).first()["flag"] == 1
    assert scalars.null_counts(plain, ["amount", "gone"]).first() == (0, 1)
