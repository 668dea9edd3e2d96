"""Marketplace raw tables from a TPC-H-shaped star schema plus an event log.

A deterministic projection that grows with its input: line items become bookings and
inventory, parts become experiences, the event log becomes clickstream. Some parts and
suppliers are held out so that broken references exist.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from excursio.functions.scalars import make_id
from excursio.schemas import columns, schema_of
from excursio.warehouse import Warehouse

AS_OF = dt.date(2002, 1, 1)
CALENDAR = (dt.date(1995, 1, 1), dt.date(2025, 1, 1))

# Declared, so that opening a table needs no job to infer its schema.
STAR_SCHEMAS = {
    "nation": schema_of("n_nationkey int, n_name string, n_regionkey int"),
    "customer": schema_of(
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "supplier": schema_of("s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double"),
    "part": schema_of(
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
    "orders": schema_of(
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": schema_of(
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": schema_of(
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string"
    ),
}

# How star-schema codes map to marketplace vocabularies.
_SUPPLIER_TYPES = (
    "Tour Operator",
    "Attraction",
    "Museum",
    "Theme Park",
    "Cruise Operator",
    "Activity Provider",
)
_CATEGORY_BY_TYPE = {
    "ECONOMY": "Adventure",
    "LARGE": "Cruise",
    "MEDIUM": "Museum",
    "PROMO": "Attraction",
    "SMALL": "Show",
    "STANDARD": "Theme Park",
}
_SEGMENT_BY_MARKET = {
    "AUTOMOBILE": "New",
    "BUILDING": "Repeat",
    "FURNITURE": "VIP",
    "HOUSEHOLD": "Dormant",
}
_CHANNELS = ("Organic", "Google Ads", "Meta Ads", "Affiliate", "Email", "Direct")
_LANGUAGES = ("English", "German", "French", "Arabic")
_CHANNEL_BY_PRIORITY = {
    "1-URGENT": "MOBILE",
    "2-HIGH": "MOBILE",
    "3-MEDIUM": "WEB",
    "4-NOT SPECIFIED": "WEB",
    "5-LOW": "PARTNER",
}
_STATUS_BY_FLAG = {"N": "CONFIRMED", "A": "CANCELLED", "R": "REFUNDED"}
_PAYMENT_BY_STATUS = {"F": "PAID", "O": "PENDING", "P": "FAILED"}
_STAGE_BY_EVENT = {
    "error": "SEARCH",
    "view": "VIEW_EXPERIENCE",
    "click": "CHECK_AVAILABILITY",
    "signup": "CHECKOUT",
    "purchase": "PURCHASE",
}
_DEVICES = ("mobile", "desktop", "tablet")
_TRAFFIC = ("organic", "google_ads", "meta_ads", "affiliate", "email", "direct")
_SLOT_CAPACITY = 40


def open_warehouse(spark: SparkSession, folder: str) -> Warehouse:
    return Warehouse(spark, raw_tables(spark, folder), as_of=AS_OF, calendar=CALENDAR)


def raw_tables(spark: SparkSession, folder: str) -> dict[str, Callable[[], DataFrame]]:
    """Openers by table name; nothing is read or planned before a table is asked for."""

    def table(name: str, build: Callable[..., DataFrame], *star: str) -> Callable[[], DataFrame]:
        def opened() -> DataFrame:
            return build(*[_read(spark, folder, s) for s in star]).select(*columns(name))

        return opened

    return {
        "suppliers": table("suppliers", _suppliers, "supplier", "nation"),
        "experiences": table("experiences", _experiences, "part", "lineitem"),
        "customers": table("customers", _customers, "customer", "nation", "orders"),
        "availability": table("availability", _availability, "lineitem"),
        "bookings": table("bookings", _bookings, "lineitem", "orders"),
        "web_events": table("web_events", _web_events, "events"),
    }


def _read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(STAR_SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def event_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The event log as a clickstream; the pattern fits a single file and a folder of files."""
    log = spark.readStream.schema(STAR_SCHEMAS["events"]).parquet(f"{folder}/events.parquet*")
    return _web_events(log).select(*columns("web_events"))


def _recode(values: dict[str, str], code: Column, otherwise: Column | None = None) -> Column:
    chosen = None
    for source, target in values.items():
        test = code == source
        chosen = F.when(test, target) if chosen is None else chosen.when(test, target)
    return chosen if otherwise is None else chosen.otherwise(otherwise)


def _cycle(values: tuple[str, ...], number: Column) -> Column:
    place = F.pmod(number, F.lit(len(values))).cast("int")
    return F.element_at(F.array(*[F.lit(v) for v in values]), place + 1)


def _cents_down(amount: Column) -> Column:
    return F.floor(amount * 100) / 100


def _experience_key(part: Column) -> Column:
    return make_id("EXP", part, 6)


def _suppliers(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    key = F.col("s_suppkey")
    start = F.lit(dt.date(2020, 1, 1))
    return (
        supplier.filter(key % 97 != 13)
        .join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey"))  # 25 nations
        .select(
            make_id("SUP", key, 5).alias("supplier_id"),
            F.col("s_name").alias("supplier_name"),
            F.col("n_name").alias("country"),
            _cycle(_SUPPLIER_TYPES, key).alias("supplier_type"),
            F.date_add(start, (key % 1000).cast("int")).alias("contract_start_date"),
            (F.lit(0.10) + (key % 21) / 100).alias("commission_rate"),
            F.when(key % 20 == 0, "INACTIVE").otherwise("ACTIVE").alias("supplier_status"),
        )
    )


def _experiences(part: DataFrame, lineitem: DataFrame) -> DataFrame:
    operator = lineitem.groupBy(F.col("l_partkey").alias("p_partkey")).agg(
        F.min("l_suppkey").alias("suppkey")
    )
    return (
        part.filter(F.col("p_partkey") % 97 != 0)
        .join(operator, "p_partkey", "left")
        .select(
            _experience_key(F.col("p_partkey")).alias("experience_id"),
            F.col("p_name").alias("experience_name"),
            F.col("p_brand").alias("city"),
            F.concat(F.lit("NATION_"), F.col("p_size") % 25).alias("country"),
            _recode(_CATEGORY_BY_TYPE, F.col("p_type")).alias("category"),
            F.when(F.col("suppkey").isNotNull(), make_id("SUP", F.col("suppkey"), 5)).alias(
                "supplier_id"
            ),
            F.col("p_retailprice").alias("base_price"),
            F.col("p_size").alias("capacity"),
            (F.lit(3.5) + (F.col("p_size") % 16) / 10).alias("rating"),
            (F.col("p_partkey") % 33 != 0).alias("active_flag"),
        )
    )


def _customers(customer: DataFrame, nation: DataFrame, orders: DataFrame) -> DataFrame:
    first_order = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.min("o_orderdate").alias("first_order")
    )
    market = F.col("c_mktsegment")
    # Some customers signed up again late, after bookings they had already made.
    again = F.when(F.col("c_custkey") % 7 == 0, F.lit(dt.date(2001, 11, 1)))
    return (
        customer.join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(first_order, "c_custkey", "left")
        .select(
            make_id("C", F.col("c_custkey")).alias("customer_id"),
            F.coalesce(again, F.to_date("first_order")).alias("signup_date"),
            F.col("n_name").alias("country"),
            _cycle(_LANGUAGES, F.col("c_nationkey")).alias("preferred_language"),
            _cycle(_CHANNELS, F.col("c_custkey")).alias("acquisition_channel"),
            _recode(_SEGMENT_BY_MARKET, market, market).alias("customer_segment"),
        )
    )


def _availability(lineitem: DataFrame) -> DataFrame:
    slot = F.when(F.col("l_linenumber") % 2 == 0, "09:00").otherwise("11:00")
    free = F.lit(_SLOT_CAPACITY) - F.sum("l_quantity").cast("int")
    return (
        lineitem.groupBy("l_partkey", F.to_date("l_shipdate").alias("day"), slot.alias("slot"))
        .agg(
            F.greatest(F.lit(0), free).alias("available_capacity"),
            F.avg(F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        )
        .select(
            _experience_key(F.col("l_partkey")).alias("experience_id"),
            F.col("day").alias("experience_date"),
            F.col("slot").alias("time_slot"),
            F.lit(_SLOT_CAPACITY).alias("total_capacity"),
            "available_capacity",
            "price",
        )
    )


def _bookings(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    order = F.col("l_orderkey")
    guests = F.col("l_quantity").cast("int")
    price = _cents_down(F.col("l_extendedprice") / F.col("l_quantity"))
    discount_pct = F.round(F.col("l_discount") * 3 + F.lit(0.0), 2)
    discount = _cents_down(price * guests * discount_pct)
    amount = F.floor((price * guests - discount) * 100 + 0.5) / 100
    lead = F.datediff("l_shipdate", "o_orderdate")
    return (
        lineitem.join(orders, order == F.col("o_orderkey"))
        .filter(F.col("o_custkey") % 50 != 0)
        .select(
            make_id("B", order * 10 + F.col("l_linenumber")).alias("booking_id"),
            F.when(order % 500 != 0, make_id("C", F.col("o_custkey"))).alias("customer_id"),
            _experience_key(F.col("l_partkey")).alias("experience_id"),
            F.col("o_orderdate").alias("booking_timestamp"),
            F.to_date("l_shipdate").alias("experience_date"),
            guests.alias("number_of_guests"),
            price.alias("ticket_price"),
            discount.alias("discount_amount"),
            F.when(order % 400 == 1, -amount).otherwise(amount).alias("booking_amount"),
            _recode(_CHANNEL_BY_PRIORITY, F.col("o_orderpriority")).alias("booking_channel"),
            F.lit("USD").alias("currency"),
            F.pmod(lead, F.lit(121)).alias("lead_time_days"),
            discount_pct.alias("discount_pct"),
            _recode(_STATUS_BY_FLAG, F.col("l_returnflag")).alias("booking_status"),
            _recode(_PAYMENT_BY_STATUS, F.col("o_orderstatus")).alias("payment_status"),
        )
    )


def _web_events(events: DataFrame) -> DataFrame:
    subject = F.get_json_object("props", "$.k").cast("bigint")
    stage = _recode(_STAGE_BY_EVENT, F.col("event_type"))
    day = F.date_format("ts", "yyyy-MM-dd")
    return events.select(
        make_id("EVT", F.col("event_id"), 7).alias("event_id"),
        make_id("C", F.col("user_id")).alias("customer_id"),
        F.concat_ws("-", F.concat(F.lit("S"), F.col("user_id")), day).alias("session_id"),
        F.when(stage != "SEARCH", _experience_key(subject)).alias("experience_id"),
        F.col("ts").alias("event_timestamp"),
        stage.alias("event_type"),
        _cycle(_DEVICES, F.col("event_id")).alias("device_type"),
        _cycle(_TRAFFIC, F.col("event_id")).alias("traffic_source"),
        F.concat(F.lit("Brand#"), subject % 25 + 1).alias("city_searched"),
    )
