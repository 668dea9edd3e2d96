"""Models and reports over the small marketplace with known defects."""

from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from excursio.plans import business, checks, features, kpis
from excursio.operators import quality
from excursio.warehouse import Warehouse, models
from tests.conftest import AS_OF, CALENDAR, as_dicts, defect_rows, frames

SHAPES = {
    "stg_bookings": 12,
    "stg_web_events": 8,
    "int_booking_details": 10,
    "int_orphaned_bookings": 1,
    "int_customer_activity": 3,
    "int_experience_daily_metrics": 20,
    "dim_date": 121,
    "fact_bookings": 10,
    "ml_demand_features": 20,
}


def test_all_21_models_build(market):
    assert len(models()) == 21
    for name, rows in SHAPES.items():
        assert market.table(name).count() == rows, name


def test_dedup_keeps_the_earliest_and_most_complete_copy(market):
    kept = {r["booking_id"]: r for r in market.table("stg_bookings").collect()}
    assert kept["B4"]["booking_timestamp"] == dt.datetime(2025, 12, 26, 10)
    assert kept["B2"]["customer_id"] == "C1"


def test_dedup_is_idempotent(spark, market):
    rows = defect_rows()
    doubled = {**rows, "bookings": list(reversed(rows["bookings"])) * 3}
    again = Warehouse(spark, frames(spark, doubled), as_of=AS_OF, calendar=CALENDAR)
    assert sorted(again.table("stg_bookings").collect(), key=str) == sorted(
        market.table("stg_bookings").collect(), key=str
    )


def test_booking_without_supplier_is_in_neither_side(market):
    assert [r["booking_id"] for r in checks.unaccounted_bookings(market).collect()] == ["B9"]
    assert checks.split_violation(market).first() == (12, 11)
    orphan = market.table("int_orphaned_bookings").first()
    assert (orphan["booking_id"], orphan["orphan_reason"]) == ("B8", "INVALID_EXPERIENCE_FK")


def test_customer_activity(market):
    rows = {r["customer_id"]: r for r in market.table("int_customer_activity").collect()}
    c1 = rows["C1"]
    assert (c1["total_bookings"], c1["confirmed_bookings"]) == (7, 5)
    assert (c1["cancelled_bookings"], c1["refunded_bookings"]) == (1, 1)
    assert (c1["total_sessions"], c1["purchase_events"], c1["is_repeat_booker"]) == (1, 1, True)
    quiet = rows["C3"]
    assert (quiet["total_bookings"], quiet["total_sessions"]) == (0, 0)
    assert quiet["lifetime_booking_amount"] == 0 and quiet["first_booking_at"] is None
    assert quiet["is_repeat_booker"] is False


def test_daily_metrics_keep_quiet_days_and_drop_days_without_inventory(market):
    days = {
        (r["experience_id"], r["experience_date"].day): r
        for r in market.table("int_experience_daily_metrics").collect()
    }
    busy = days["EXP000001", 2]
    assert (busy["total_bookings"], busy["cancelled_bookings"]) == (2, 1)
    assert (busy["total_capacity"], busy["utilization_rate"], busy["cancellation_rate"]) == (
        20,
        0.4,
        0.5,
    )
    quiet = days["EXP000001", 1]
    assert (quiet["total_bookings"], quiet["cancellation_rate"]) == (0, None)
    assert not [d for d in days if d[1] == 20]


def test_features_never_see_their_own_day(spark, market):
    """Changing one day's bookings must leave that day's features alone."""
    base = market.table("ml_base_features")
    changed_day = F.col("feature_date") == F.lit(dt.date(2026, 1, 6))
    shifted = base.withColumn(
        "target_bookings", F.when(changed_day, F.lit(99)).otherwise(F.col("target_bookings"))
    )
    pick = ["experience_id", "feature_date", *features.ROLLING_COLUMNS]
    before = features.add_history(base).select(pick)
    after = features.add_history(shifted).select(pick)
    differing = before.exceptAll(after).select("feature_date").distinct().collect()
    assert differing and all(r[0] > dt.date(2026, 1, 6) for r in differing)


def test_row_frames_and_day_frames_differ_only_over_gaps(market):
    base = market.table("ml_base_features").filter("experience_id = 'EXP000001'")
    pick = ["feature_date", *features.ROLLING_COLUMNS]
    whole = features.add_history(base).select(pick)
    assert whole.exceptAll(features.add_history(base, by_day=True).select(pick)).count() == 0
    gap = base.filter("feature_date <> date '2026-01-02'")
    day = F.col("feature_date") == F.lit(dt.date(2026, 1, 3))
    by_row = features.add_history(gap).filter(day).first()
    by_day = features.add_history(gap, by_day=True).filter(day).first()
    assert (by_row["bookings_prev_1d"], by_day["bookings_prev_1d"]) == (0, None)


def test_first_row_of_an_experience_has_no_history(market):
    first = market.table("ml_demand_features").filter("days_of_prior_history = 0")
    assert first.count() == 2
    assert first.filter("bookings_prev_7d_avg is not null").count() == 0
    assert market.table("ml_demand_features").columns == features.FEATURE_COLUMNS
    assert len(features.FEATURE_COLUMNS) == 23


def test_kpis(market):
    row = kpis.kpis(market).first()
    assert row["total_bookings"] == 10
    assert row["cancellation_rate"] == pytest.approx(0.2)
    rome = kpis.kpis(market, city="Rome").first()
    assert (rome["total_bookings"], rome["gmv"]) == (2, 150.0)
    nothing = kpis.kpis(market, "Nowhere", "All").first()
    assert (nothing["total_bookings"], nothing["gmv"], nothing["cancellation_rate"]) == (
        0,
        None,
        None,
    )
    assert kpis.kpis(market, "O'Hare").first()["total_bookings"] == 0


def test_repeat_rate_is_zero_without_bookings(spark, market):
    assert kpis.repeat_customer_rate(market).first()[0] == 1.0  # both who booked came back
    rows = {**defect_rows(), "bookings": []}
    empty = Warehouse(spark, frames(spark, rows), as_of=AS_OF, calendar=CALENDAR)
    assert kpis.repeat_customer_rate(empty).first()[0] == 0.0
    assert kpis.kpis(empty).count() == 1


def test_ordered_reports(market):
    assert [r["event_type"] for r in kpis.funnel(market).collect()] == [
        "SEARCH",
        "VIEW_EXPERIENCE",
        "PURCHASE",
    ]
    buckets = [r["lead_time_bucket"] for r in kpis.cancellation_by_lead_time(market).collect()]
    assert buckets == [b for b in ("<3d", "3-14d", "14-60d") if b in buckets]
    cities = [r["city"] for r in kpis.revenue_by_city(market).collect()]
    assert cities == ["Paris", "Rome"]
    assert [r["city"] for r in kpis.cities(market).collect()] == ["Paris", "Rome"]
    top = kpis.top_experiences(market, limit=1).collect()
    assert [r["experience_name"] for r in top] == ["River Walk"]


def test_metric_dictionary(market):
    total = kpis.metric(market, "total_bookings").first()[0]
    by_city = kpis.metric(market, "total_bookings", ["city", "month"]).collect()
    assert total == 10 and sum(r["total_bookings"] for r in by_city) == total
    with pytest.raises(ValueError):
        kpis.metric(market, "total_bookings", ["shoe_size"])


def test_prior_cancellations_and_risk(market):
    plain = as_dicts(business.prior_cancellations(market), "booking_id")
    ranged = as_dicts(business.prior_cancellations(market, chunks=3), "booking_id")
    assert plain == ranged
    prior = {r["booking_id"]: r["prior_cancellations"] for r in plain}
    assert [prior[b] for b in ("B1", "B2", "B3", "B4", "B11")] == [0, 1, 1, 2, 2]
    assert prior["B6"] == 0  # nobody's history
    risk = {r["booking_id"]: r["risk"] for r in business.cancellation_risk(market).collect()}
    assert risk["B11"] == pytest.approx(0.10 * 1.9)
    assert all(0.02 <= r <= 0.85 for r in risk.values())


def test_inventory_reports(market):
    over = business.over_capacity(market).collect()
    assert [(r["experience_id"], r["experience_date"].day) for r in over] == [("EXP000001", 9)]
    assert over[0]["expected_available"] == 0
    missing = {r["booking_id"] for r in business.bookings_without_inventory(market).collect()}
    assert missing == {"B8", "B9", "B12"}
    assert business.near_capacity(market, 0.4).count() == 20
    assert business.near_capacity(market, 0.41).count() == 0


def test_price_calendar(market):
    start = dt.date(2026, 1, 2)
    priced = business.price_calendar(
        market.table("dim_experience"), start, start + dt.timedelta(days=2)
    )
    rows = as_dicts(priced, "experience_id", "experience_date", "time_slot")
    assert len(rows) == 2 * (2 + 3 + 2)  # the inactive experience is left out
    assert {r["experience_id"] for r in rows} == {"EXP000001", "EXP000002", "EXP000004"}
    friday = [r for r in rows if r["experience_id"] == "EXP000001"][0]
    assert (friday["price"], friday["total_capacity"]) == (40.0, 5)


def test_sessions(market):
    violations = as_dicts(business.session_order_violations(market), "event_id")
    assert [(v["event_id"], v["not_later"], v["stage_went_back"]) for v in violations] == [
        ("EVT4", False, True),
        ("EVT7", True, False),
    ]
    ranged = business.session_order_violations(market, chunks=3)
    assert as_dicts(ranged, "event_id") == violations
    summary = {r["session_id"]: r for r in business.session_summary(market).collect()}
    assert (summary["S1"]["deepest_stage"], summary["S1"]["converted"]) == (6, True)
    assert business.browsing_session_length(market).first() == (2, 2.0)
    gaps = {r["event_id"]: r["gap_minutes"] for r in business.session_gaps(market).collect()}
    assert gaps["EVT2"] == 10.0
    drop = {r["event_type"]: r for r in business.funnel_dropoff(market).collect()}
    assert drop["SEARCH"]["step_conversion"] is None
    assert drop["PURCHASE"]["overall_conversion"] == pytest.approx(2 / 3)


def test_purchases_match_bookings(market):
    purchases, bookings = business.unmatched_purchases(market)
    assert [r["event_id"] for r in purchases.collect()] == ["EVT8"]
    assert bookings.count() == 11
    assert business.purchase_reconciliation(market).first() == (2, 12, 1, 11, False)


def test_customer_rules(market):
    assert [r["customer_id"] for r in business.segment_violations(market).collect()] == ["C2"]
    assert business.bookings_before_signup(market).count() == 0
    windows = {r["booking_window"]: r for r in business.lead_time_windows(market).collect()}
    assert sum(r["bookings"] for r in windows.values()) == 12
    assert sum(r["lead_time_as_derived"] for r in windows.values()) == 12


DEFECTS = {
    "duplicate_booking": 3,
    "duplicate_event": 1,
    "null_customer": 1,
    "negative_amount": 1,
    "late_booking": 1,
    "unknown_experience": 1,
    "out_of_order_session": 2,
}


def test_defect_profile_matches_the_answer_key(market):
    found = {r["defect"]: r["n_rows"] for r in checks.defect_profile(market).collect()}
    assert found == DEFECTS


def test_declared_checks(spark):
    assert len(checks.MODEL_CHECKS) + 1 == 69
    wh = Warehouse(spark, frames(spark, defect_rows()), as_of=AS_OF, calendar=CALENDAR)
    summary = {
        (r["table"], r["check"]): (r["severity"], r["violations"])
        for r in checks.check_models(wh).collect()
    }
    assert len(summary) == 69
    broken = {key: found for key, found in summary.items() if found[1]}
    assert broken == {
        ("stg_experiences", "relationships:supplier_id"): ("error", 1),
        ("stg_bookings", "not_null:customer_id"): ("warn", 1),
        ("stg_bookings", "relationships:experience_id"): ("warn", 1),
        ("stg_bookings", "expression:booking_amount"): ("warn", 1),
        ("stg_bookings", "booking_split_conserves_rows"): ("error", 1),
        ("dim_experience", "relationships:supplier_id"): ("error", 1),
    }
    with pytest.raises(quality.CheckFailed, match="relationships:supplier_id"):
        quality.enforce(checks.check_models(wh))


def test_violating_rows_can_be_listed(market):
    check = next(c for c in checks.MODEL_CHECKS if c.name == "expression:booking_amount")
    assert [r["booking_id"] for r in check.violations(market.table).collect()] == ["B7"]


def test_gate_and_contracts(market):
    gate = {r["rule"]: r["violations"] for r in checks.gate_all(market).collect()}
    assert gate["booking_amount >= 0"] == 1 and gate["unique booking_id"] == 3
    assert gate["known event_type"] == gate["session_id present"] == 0
    empty = market.source("bookings").limit(0)
    assert not checks.gate_batch("bookings", empty).filter("violations > 0").count()
    contract = {(r["dataset"], r["rule"]): r["violations"] for r in checks.contract_checks(market).collect()}
    assert {k: v for k, v in contract.items() if v} == {("experiences", "known supplier_id"): 1}
    with pytest.raises(ValueError, match="known supplier_id: 1"):
        checks.raise_if_invalid(checks.contract_checks(market), "catalog")
    invariants = {r["invariant"]: r["violations"] for r in checks.invariants(market).collect()}
    assert invariants["booking day has inventory"] == 3
    assert invariants["available capacity in bounds"] == 0


def test_nulls_fail_range_checks_but_pass_positive_checks(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (None,)], "v double")
    assert df.filter(quality.outside_range("v", 0, 1)).count() == 2
    assert df.filter(F.col("v") <= 0).count() == 0
    assert quality.missing_columns(df, ["v", "w"]) == ["w"]


def test_expected_demand_uses_measured_popularity(market):
    rows = business.expected_demand(market).collect()
    mean = {}
    for r in rows:
        mean.setdefault(r["experience_id"], set()).add(round(r["popularity"], 6))
    assert all(len(v) == 1 for v in mean.values())
    assert math.isclose(sum(next(iter(v)) for v in mean.values()) / len(mean), 1.0, abs_tol=1e-6)


def test_written_models_give_the_same_results(spark, market):
    wh = Warehouse(spark, frames(spark, defect_rows()), as_of=AS_OF, calendar=CALENDAR)
    wh.materialise("stg_bookings", "int_booking_details", "experience_days")
    for name in ("fact_bookings", "ml_demand_features", "int_customer_activity"):
        assert wh.table(name).exceptAll(market.table(name)).count() == 0
        assert market.table(name).exceptAll(wh.table(name)).count() == 0
    wh.create_views(["fact_bookings"])
    assert spark.sql("select count(*) from fact_bookings").first()[0] == 10


def test_sections_of_checks_are_counted_one_after_the_other(market, monkeypatch):
    summarise, counted = quality.summarise, []

    def noted(tables, declared):
        counted.append(len(declared))
        return summarise(tables, declared)

    monkeypatch.setattr(quality, "summarise", noted)
    rows = checks.check_models(market).collect()
    assert len(counted) == 4 and sum(counted) == len(checks.MODEL_CHECKS) == len(rows) - 1  # and the conservation test
    assert max(counted) < len(checks.MODEL_CHECKS) / 2
