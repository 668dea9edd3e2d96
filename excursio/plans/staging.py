"""Staging models: fixed column lists; bookings and events keep one row per id."""

from __future__ import annotations

from pyspark.sql import DataFrame

from excursio.operators.dedup import keep_first
from excursio.schemas import columns
from excursio.warehouse import Warehouse


def _project(table: str):
    def build(wh: Warehouse) -> DataFrame:
        return wh.source(table).select(*columns(table))

    return build


def stg_bookings(wh: Warehouse) -> DataFrame:
    bookings = wh.source("bookings").select(*columns("bookings"))
    return keep_first(bookings, ["booking_id"], ["booking_timestamp"])


def stg_web_events(wh: Warehouse) -> DataFrame:
    events = wh.source("web_events").select(*columns("web_events"))
    return keep_first(events, ["event_id"], ["event_timestamp"])


MODELS = {
    "stg_suppliers": _project("suppliers"),
    "stg_experiences": _project("experiences"),
    "stg_customers": _project("customers"),
    "stg_availability": _project("availability"),
    "stg_bookings": stg_bookings,
    "stg_web_events": stg_web_events,
}
