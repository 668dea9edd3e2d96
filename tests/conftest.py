from __future__ import annotations

import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from excursio.schemas import RAW_SCHEMAS  # noqa: E402
from excursio.session import local_session  # noqa: E402
from excursio.warehouse import Warehouse  # noqa: E402

AS_OF = dt.date(2026, 3, 1)
CALENDAR = (dt.date(2025, 12, 1), dt.date(2026, 4, 1))


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 4, 4)
    yield session
    session.stop()


def at(day: str, clock: str = "10:00") -> dt.datetime:
    return dt.datetime.fromisoformat(f"{day}T{clock}:00")


def booking(number, customer, experience, booked, visit, guests=2, status="CONFIRMED", **other):
    price = other.pop("price", 50.0)
    row = {
        "booking_id": f"B{number}",
        "customer_id": customer,
        "experience_id": experience,
        "booking_timestamp": booked,
        "experience_date": dt.date.fromisoformat(visit),
        "number_of_guests": guests,
        "ticket_price": price,
        "discount_amount": 0.0,
        "booking_amount": price * guests,
        "booking_channel": "WEB",
        "currency": "USD",
        "lead_time_days": (dt.date.fromisoformat(visit) - booked.date()).days,
        "discount_pct": 0.0,
        "booking_status": status,
        "payment_status": "PAID",
    }
    return {**row, **other}


def event(number, session, customer, when, stage, experience=None):
    return {
        "event_id": f"EVT{number}",
        "customer_id": customer,
        "session_id": session,
        "experience_id": experience,
        "event_timestamp": when,
        "event_type": stage,
        "device_type": "mobile",
        "traffic_source": "organic",
        "city_searched": "Paris",
    }


def defect_rows() -> dict[str, list[dict]]:
    """A small marketplace with a known number of each defect."""
    suppliers = [
        ("SUP00001", "Seine Tours", "France", "Tour Operator", dt.date(2025, 3, 1), 0.15, "ACTIVE"),
        ("SUP00002", "Roma Arte", "Italy", "Museum", dt.date(2024, 3, 1), 0.20, "INACTIVE"),
    ]
    experiences = [
        ("EXP000001", "River Walk", "Paris", "France", "Guided Tour", "SUP00001", 50.0, 10, 4.6, True),
        ("EXP000002", "Old Masters", "Rome", "Italy", "Museum", "SUP00002", 20.0, 30, 3.9, True),
        ("EXP000003", "Cliff Climb", "Paris", "France", "Adventure", "SUP00001", 90.0, 5, 4.2, False),
        # its supplier does not exist
        ("EXP000004", "Ghost Cruise", "Rome", "Italy", "Cruise", "SUP99999", 70.0, 20, 4.0, True),
    ]
    customers = [
        ("C1", dt.date(2025, 1, 1), "USA", "English", "Organic", "Repeat"),
        ("C2", dt.date(2025, 12, 20), "France", "French", "Email", "VIP"),  # too young for VIP
        ("C3", dt.date(2025, 6, 1), "UK", "English", "Direct", "Dormant"),  # never books
    ]
    availability = [
        (exp, dt.date(2026, 1, day), slot, 10, 6, price)
        for exp, price in (("EXP000001", 50.0), ("EXP000002", 20.0))
        for day in range(1, 11)
        for slot in ("09:00", "11:00")
    ]
    bookings = [
        booking(1, "C1", "EXP000001", at("2025-12-20"), "2026-01-02", status="CANCELLED"),
        booking(2, "C1", "EXP000001", at("2025-12-22"), "2026-01-02"),
        booking(3, "C1", "EXP000002", at("2025-12-24"), "2026-01-05", status="REFUNDED"),
        booking(4, "C1", "EXP000001", at("2025-12-26"), "2026-01-08"),
        booking(5, "C2", "EXP000002", at("2025-12-28"), "2026-01-05", guests=3),
        # exact copy
        booking(5, "C2", "EXP000002", at("2025-12-28"), "2026-01-05", guests=3),
        # copy with a later time: the earlier one must win
        booking(4, "C1", "EXP000001", at("2025-12-27"), "2026-01-08"),
        # copy without its customer: the complete one must win
        booking(2, None, "EXP000001", at("2025-12-22"), "2026-01-02"),
        booking(6, None, "EXP000001", at("2025-12-25"), "2026-01-03"),
        booking(7, "C2", "EXP000001", at("2025-12-26"), "2026-01-03", booking_amount=-100.0),
        booking(8, "C2", "EXP999999", at("2025-12-26"), "2026-01-03"),
        booking(9, "C2", "EXP000004", at("2025-12-26"), "2026-01-03"),
        booking(10, "C1", "EXP000001", at("2026-01-09"), "2026-01-07"),  # late
        booking(11, "C1", "EXP000001", at("2025-12-30"), "2026-01-09", guests=25),  # oversold
        booking(12, "C1", "EXP000001", at("2025-12-30"), "2026-02-20"),  # no inventory that day
    ]
    events = [
        event(1, "S1", "C1", at("2025-12-20", "09:00"), "SEARCH"),
        event(2, "S1", "C1", at("2025-12-20", "09:10"), "VIEW_EXPERIENCE", "EXP000001"),
        event(3, "S1", "C1", at("2025-12-20", "10:00"), "PURCHASE", "EXP000001"),
        event(3, "S1", "C1", at("2025-12-20", "10:00"), "PURCHASE", "EXP000001"),  # copy
        event(4, "S2", "C2", at("2025-12-21", "09:05"), "SEARCH"),  # swapped with the next
        event(5, "S2", "C2", at("2025-12-21", "09:00"), "VIEW_EXPERIENCE", "EXP000002"),
        event(6, "S3", "C2", at("2025-12-22", "09:00"), "SEARCH"),
        event(7, "S3", "C2", at("2025-12-22", "09:00"), "VIEW_EXPERIENCE", "EXP000002"),  # tie
        event(8, "S4", "C2", at("2025-12-23", "09:00"), "PURCHASE", "EXP000002"),  # no booking
    ]
    return {
        "suppliers": suppliers,
        "experiences": experiences,
        "customers": customers,
        "availability": availability,
        "bookings": bookings,
        "web_events": events,
    }


def frames(spark, rows: dict[str, list]) -> dict:
    def frame(name):
        schema = RAW_SCHEMAS[name]
        values = [
            tuple(r[c] for c in schema.fieldNames()) if isinstance(r, dict) else r
            for r in rows[name]
        ]
        return spark.createDataFrame(values, schema)

    return {name: frame(name) for name in rows}


@pytest.fixture(scope="session")
def market(spark):
    """Warehouse over the defect rows."""
    return Warehouse(spark, frames(spark, defect_rows()), as_of=AS_OF, calendar=CALENDAR)


def as_dicts(df, *order):
    rows = [r.asDict() for r in df.collect()]
    return sorted(rows, key=lambda r: tuple(str(r[c]) for c in order)) if order else rows
