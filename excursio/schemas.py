"""Contracts of the six raw tables and the fixed vocabularies used across the models."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def schema_of(spec: str) -> T.StructType:
    """All columns nullable, so that dirty rows can land."""
    schema = T.StructType()
    for field in spec.split(","):
        name, kind = field.split()
        schema.add(name, _TYPES[kind], nullable=True)
    return schema


RAW_SCHEMAS: dict[str, T.StructType] = {
    "suppliers": schema_of(
        "supplier_id string, supplier_name string, country string, supplier_type string, "
        "contract_start_date date, commission_rate double, supplier_status string"
    ),
    "experiences": schema_of(
        "experience_id string, experience_name string, city string, country string, "
        "category string, supplier_id string, base_price double, capacity int, "
        "rating double, active_flag boolean"
    ),
    "customers": schema_of(
        "customer_id string, signup_date date, country string, preferred_language string, "
        "acquisition_channel string, customer_segment string"
    ),
    "availability": schema_of(
        "experience_id string, experience_date date, time_slot string, total_capacity int, "
        "available_capacity int, price double"
    ),
    "bookings": schema_of(
        "booking_id string, customer_id string, experience_id string, "
        "booking_timestamp timestamp_ntz, experience_date date, number_of_guests int, "
        "ticket_price double, discount_amount double, booking_amount double, "
        "booking_channel string, currency string, lead_time_days int, discount_pct double, "
        "booking_status string, payment_status string"
    ),
    "web_events": schema_of(
        "event_id string, customer_id string, session_id string, experience_id string, "
        "event_timestamp timestamp_ntz, event_type string, device_type string, "
        "traffic_source string, city_searched string"
    ),
}

# Tables that grow every day, in load order.
DAILY_TABLES = ("availability", "bookings", "web_events")

# The vocabularies the contracts allow.
SUPPLIER_STATUSES = ("ACTIVE", "INACTIVE")
CUSTOMER_SEGMENTS = ("New", "Repeat", "VIP", "Dormant")
BOOKING_STATUSES = ("CONFIRMED", "CANCELLED", "REFUNDED")
LOST_STATUSES = ("CANCELLED", "REFUNDED")
FUNNEL_STAGES = (
    "SEARCH",
    "VIEW_EXPERIENCE",
    "CHECK_AVAILABILITY",
    "ADD_TO_CART",
    "CHECKOUT",
    "PURCHASE",
)
ORPHAN_REASON = "INVALID_EXPERIENCE_FK"


def columns(table: str) -> list[str]:
    return RAW_SCHEMAS[table].fieldNames()
