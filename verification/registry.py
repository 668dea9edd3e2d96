"""Queries by name, each over the whole tables of a data folder.

Averages and money sums are rounded here so that engines adding doubles in a different order
agree; the library itself returns unrounded values.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from excursio.functions.calendar import spine_over
from excursio.functions.scalars import null_counts
from excursio.operators.joins import split_by_parent
from excursio.operators.measures import distinct_where, value_distribution
from excursio.plans import business, checks, kpis, training
from excursio.plans.marts import calendar_rows
from excursio.schemas import RAW_SCHEMAS, columns
from excursio.session import configure
from excursio.sources import state
from excursio.sources.landing import (
    QUARANTINE,
    Lake,
    backfill,
    ingest,
    load_reconciliation,
    read_quarantine,
    read_raw,
    write_landing,
)
from excursio.shared import shared_folder, write_shared
from excursio.sources.star_adapter import event_stream, open_warehouse
from excursio.streaming import events as stream_events
from excursio.warehouse import Warehouse

Query = Callable[[SparkSession, str], DataFrame]

CITY, CATEGORY = "Brand#7", "Museum"
PRICED_FROM, PRICED_UNTIL = dt.date(1996, 6, 27), dt.date(1996, 7, 4)


def rounded(df: DataFrame, digits: int = 4, **special: int) -> DataFrame:
    """Round every double column."""
    doubles = [f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: F.round(c, special.get(c, digits)) for c in doubles})


def _on_warehouse(build: Callable[[Warehouse], DataFrame], digits: int = 4, **special: int):
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return rounded(build(open_warehouse(configure(spark), folder)), digits, **special)

    return query


def _model(name: str, digits: int = 4, **special: int) -> Query:
    return _on_warehouse(lambda wh: wh.table(name), digits, **special)


def queries() -> dict[str, Query]:
    on = _on_warehouse
    models = {
        "stg_suppliers": _model("stg_suppliers"),
        "stg_experiences": _model("stg_experiences"),
        "stg_customers": _model("stg_customers"),
        "stg_availability": _model("stg_availability", price=7),
        "stg_bookings_dedup": _model("stg_bookings"),
        "stg_web_events": _model("stg_web_events"),
        "booking_details": _model("int_booking_details"),
        "orphaned_bookings": _model("int_orphaned_bookings"),
        "customer_activity": _model("int_customer_activity"),
        "experience_daily_metrics": _model("int_experience_daily_metrics"),
        "dim_customer": _model("dim_customer"),
        "dim_supplier": _model("dim_supplier"),
        "dim_experience": _model("dim_experience"),
        "dim_date": on(
            lambda wh: calendar_rows(spine_over(wh.table("stg_availability"), "experience_date"))
        ),
        "fact_bookings": _model("fact_bookings"),
        "fact_web_events": _model("fact_web_events"),
        "fact_availability": _model("fact_experience_availability", price=7),
        "ml_daily_price": _model("ml_daily_price", avg_price=7),
        "ml_base_features": _model("ml_base_features", avg_price=7),
        "ml_rolling_features": _model("ml_rolling_features", 8, avg_price=7),
        "ml_demand_features": _model("ml_demand_features", 8, avg_price=7),
    }
    dashboard = {
        "filter_options": on(kpis.filter_options),
        "kpis_all": on(kpis.kpis),
        "kpis_filtered": on(lambda wh: kpis.kpis(wh, CITY, CATEGORY)),
        "kpis_nothing_matches": on(lambda wh: kpis.kpis(wh, "Nowhere")),
        "repeat_customer_rate": on(kpis.repeat_customer_rate, 6),
        "monthly_trend": on(kpis.monthly_trend),
        "monthly_trend_filtered": on(lambda wh: kpis.monthly_trend(wh, CITY, CATEGORY)),
        "city_growth": on(kpis.city_growth, 6),
        "revenue_by_city": on(kpis.revenue_by_city),
        "revenue_by_city_filtered": on(lambda wh: kpis.revenue_by_city(wh, CATEGORY)),
        "funnel": on(kpis.funnel),
        "top_experiences": on(kpis.top_experiences),
        "top_experiences_filtered": on(
            lambda wh: kpis.top_experiences(wh, CITY, CATEGORY, limit=5)
        ),
        "cancellation_by_lead_time": on(kpis.cancellation_by_lead_time),
        "cancellation_by_lead_time_filtered": on(
            lambda wh: kpis.cancellation_by_lead_time(wh, CITY)
        ),
        "channel_mix": on(kpis.channel_mix),
        "channel_mix_filtered": on(lambda wh: kpis.channel_mix(wh, category=CATEGORY)),
        "metric_cancellation_rate": on(
            lambda wh: kpis.metric(wh, "cancellation_rate", ["category", "booking_channel"])
        ),
        "metric_gmv_by_year": on(lambda wh: kpis.metric(wh, "gmv", ["year", "city"])),
        "metric_total_bookings": on(lambda wh: kpis.metric(wh, "total_bookings")),
        "metric_repeat_by_segment": on(
            lambda wh: kpis.metric(wh, "repeat_customer_rate", ["customer_segment"]), 6
        ),
    }
    rules = {
        "price_calendar": on(
            lambda wh: business.price_calendar(
                wh.table("dim_experience"), PRICED_FROM, PRICED_UNTIL
            )
        ),
        "expected_demand": on(business.expected_demand, 6),
        "prior_cancellations": on(business.prior_cancellations),
        "cancellation_counts": on(business.cancellation_counts),
        "cancellation_risk": on(business.cancellation_risk, 6),
        "risk_calibration": on(business.risk_calibration, 6),
        "inventory_reconciliation": on(business.reconcile_inventory),
        "over_capacity": on(business.over_capacity),
        "near_capacity": on(business.near_capacity),
        "amount_mismatches": on(business.amount_mismatches),
        "funnel_dropoff": on(business.funnel_dropoff, 6),
        "session_summary": on(business.session_summary),
        "browsing_session_length": on(business.browsing_session_length, 6),
        "session_order_violations": on(business.session_order_violations),
        "session_gaps": on(business.session_gaps, 8),
        "segment_violations": on(business.segment_violations),
        "late_bookings": on(business.late_bookings),
        "lead_time_windows": on(business.lead_time_windows),
        "bookings_before_signup": on(business.bookings_before_signup),
        "bookings_without_inventory": on(business.bookings_without_inventory),
        "purchase_reconciliation": on(business.purchase_reconciliation),
        "value_distribution": on(
            lambda wh: value_distribution(wh.table("stg_bookings"), "booking_status"), 6
        ),
    }
    lookups = {
        "active_experiences": on(lambda wh: state.active_experiences(wh.table("dim_experience"))),
        "customer_ids": on(lambda wh: state.customer_ids(wh.table("dim_customer"))),
        "customer_cancellation_counts": on(
            lambda wh: business.with_cancellation_counts(
                wh, wh.table("dim_customer").select("customer_id")
            )
        ),
        "purchase_sessions": on(
            lambda wh: distinct_where(
                wh.table("fact_web_events"),
                F.col("event_type") == "PURCHASE",
                "session_id",
                "purchase_sessions",
            )
        ),
        "next_event_number": on(
            lambda wh: state.next_number(
                wh.source("web_events"), "event_id", "EVT", state.EVENT_BASE
            )
        ),
    }
    quality = {
        "booking_split_counts": on(checks.split_counts),
        "booking_split_conservation": on(checks.split_violation),
        "unaccounted_bookings": on(checks.unaccounted_bookings),
        "dq_summary": on(checks.check_models),
        "dq_profile": on(checks.defect_profile),
        "batch_gate": on(checks.gate_all),
        "contract_checks": on(checks.contract_checks),
        "invariants": on(checks.invariants),
        "raw_row_counts": on(lambda wh: checks.row_counts(wh, tuple(RAW_SCHEMAS))),
        "null_counts": on(lambda wh: null_counts(wh.source("bookings"), columns("bookings"))),
        "next_booking_number": on(
            lambda wh: state.next_number(
                wh.source("bookings"), "booking_id", "B", state.BOOKING_BASE
            )
        ),
    }
    forecasting = {
        "chronological_split": on(_split),
        "baseline_scores": on(_baselines),
        "imputed_feature_counts": on(
            lambda wh: null_counts(_training_rows(wh), training.NUMERIC_FEATURES)
        ),
        "next_day_features": on(training.next_day_features, 8, avg_price=7),
        "model_leaderboard": on(_leaderboard),
        "champion_gate": on(lambda wh: training.gate(_leaderboard(wh), None)),
        "gate_history": on(_gate_history),
        "ridge_leaderboard": on(_ridge_leaderboard),
        "ridge_weights": on(_ridge_weights, 6),
        "next_day_forecast": on(_next_day_forecast, 6),
    }
    rules["purchase_matches"] = on(
        lambda wh: business.purchase_matches(_purchases(wh), wh.table("stg_bookings"))
    )
    streams = {
        "stream_dedup": _streamed(
            lambda events: stream_events.deduplicated(events, "event_id", "event_timestamp")
        ),
        "stream_daily_stages": _stored(
            stream_events.stage_days, stream_events.daily_stage_sessions
        ),
        "stream_daily_stages_approx": _approximate_stages,
        "stream_sessions": _stored(stream_events.visits, stream_events.activity_sessions),
    }
    streams.update(
        stream_prior_cancellations=on(_tracked_cancellations),
        stream_enriched_bookings=on(_enriched_stream),
        stream_late_bookings=on(_late_stream),
        stream_dedup_counts=on(lambda wh: _deduplicated(wh)[0]),
        stream_dedup_late=on(lambda wh: _deduplicated(wh)[1]),
        stream_matched_purchases=on(lambda wh: _matched_stream(wh, "inner")),
        stream_unmatched_purchases=on(_unmatched_stream),
    )
    loads = {
        "landed_events": on(lambda wh: read_raw(wh.spark, _landed(wh), "web_events")),
        "load_reconciliation": on(
            lambda wh: load_reconciliation(wh.spark, _landed(wh), "web_events")
        ),
        "repeated_loads": on(_loaded_again),
        "interleaved_loads": on(_interleaved_loads),
        "quarantined_bookings": on(_quarantined),
        "rejects_by_reason": on(lambda wh: _dirty_landing(wh)[0]),
        "rejects_by_day": on(lambda wh: _dirty_landing(wh)[1]),
        "bookings_after_rejects": on(lambda wh: _dirty_landing(wh)[2]),
    }
    groups = (models, dashboard, rules, lookups, quality, forecasting, streams, loads)
    return {name: query for group in groups for name, query in group.items()}


def _place(wh: Warehouse, label: str) -> str:
    return f"{shared_folder(wh.spark)}/{label}-{uuid.uuid4().hex}"


def _landed(wh: Warehouse) -> Lake:
    """The event table written as day-partitioned CSV files and loaded back from them."""
    place = _place(wh, "landing")
    lake = Lake(f"{place}/files", f"{place}/lake")
    write_landing(wh.source("web_events"), lake, "web_events", "event_timestamp")
    ingest(wh.spark, lake, "web_events")
    return lake


def _loaded_again(wh: Warehouse) -> DataFrame:
    """The same files by day, with all days and by backfill: each counts once."""
    place = _place(wh, "landing")
    lake = Lake(f"{place}/files", f"{place}/lake")
    events = wh.source("web_events")
    write_landing(events, lake, "web_events", "event_timestamp")
    first, last = events.agg(
        F.to_date(F.min("event_timestamp")), F.to_date(F.max("event_timestamp"))
    ).first()
    ingest(wh.spark, lake, "web_events", first)
    ingest(wh.spark, lake, "web_events")
    backfill(wh.spark, lake, "web_events", first, last + dt.timedelta(days=1))
    ingest(wh.spark, lake, "web_events", last)
    return load_reconciliation(wh.spark, lake, "web_events")


def _dirty_landing(wh: Warehouse) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Bookings as files with empty tokens, unreadable values, broken rules and repeats, loaded in quarantine mode."""
    place = _place(wh, "landing")
    lake = Lake(f"{place}/files", f"{place}/lake")
    number = F.substring("booking_id", 2, 20).cast("bigint")
    texts = wh.source("bookings").select(*[F.col(c).cast("string").alias(c) for c in columns("bookings")])
    dirt = {
        "booking_timestamp": (113, "yesterday"),
        "number_of_guests": (101, "many"),
        "booking_amount": (103, "NULL"),
        "customer_id": (107, "null"),
        "currency": (109, ""),
    }
    # Repeats by a generator, not a union, which would build the bookings twice; the days are the few years.
    twice = F.explode(F.when(number % 127 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    dirty = texts.select("*", twice.alias("copy")).withColumns({c: F.when(number % n == 0, F.lit(t)).otherwise(F.col(c)) for c, (n, t) in dirt.items()})
    write_landing(dirty.drop("copy"), lake, "bookings", F.trunc("experience_date", "year"), gather=False)
    ingest(wh.spark, lake, "bookings", on_violation=QUARANTINE)
    refused = read_quarantine(wh.spark, lake, "bookings")
    by_reason = refused.groupBy("reason").agg(F.count("*").alias("n_rows"))
    return by_reason, load_reconciliation(wh.spark, lake, "bookings"), read_raw(wh.spark, lake, "bookings")


def _interleaved_loads(wh: Warehouse) -> DataFrame:
    """Backfills, day loads and loads of all days in three orders, each over a lake of its own."""
    place = _place(wh, "landing")
    events = wh.source("web_events")
    write_landing(events, Lake(f"{place}/files", place), "web_events", "event_timestamp")
    first, last = events.agg(
        F.to_date(F.min("event_timestamp")), F.to_date(F.max("event_timestamp"))
    ).first()
    middle, end = first + (last - first) // 2, last + dt.timedelta(days=1)
    early, late, whole = (first, middle), (middle, end), (first, end)
    orders = {
        "halves, then all": (early, late, None, first),
        "a day, then overlapping": (last, (first, last), late, None),
        "late, all, whole": (late, None, whole, early),
    }
    found = []
    for name, steps in orders.items():
        lake = Lake(f"{place}/files", f"{place}/{len(found)}")
        for step in steps:
            if isinstance(step, tuple):
                backfill(wh.spark, lake, "web_events", *step)
            else:
                ingest(wh.spark, lake, "web_events", step)
        counted = load_reconciliation(wh.spark, lake, "web_events")
        found.append(counted.select(F.lit(name).alias("load_order"), *counted.columns))
    return found[0].unionByName(found[1]).unionByName(found[2])


def _quarantined(wh: Warehouse) -> DataFrame:
    bookings = wh.table("stg_bookings").select("booking_id", "experience_id")
    known = wh.table("stg_experiences")
    return split_by_parent(bookings, known, "experience_id", "unknown experience")[1]


def _in_batches(wh: Warehouse, df: DataFrame, label: str, files: int = 4) -> DataFrame:
    """A table as a stream of several batches, dealt out by a hash: rows come in no order."""
    place = _place(wh, label)
    df.repartition(files).write.parquet(place)
    reader = wh.spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1)
    return reader.parquet(place)


def _in_order(wh: Warehouse, df: DataFrame, stamp: str, label: str, parts: int = 4) -> DataFrame:
    """A table as a stream of several batches, one for each stretch of time, in order.

    With a column ``part`` rows come in that part instead.
    """
    place = _place(wh, label)
    if "part" not in df.columns:
        df = df.withColumn("part", _stretch(df, stamp, parts))
    df = write_shared(df, label)
    for part in range(parts):  # one write after the other: files are read in the order of their times
        df.filter(F.col("part") == part).drop("part").coalesce(1).write.mode("append").parquet(place)
    reader = wh.spark.readStream.schema(df.drop("part").schema).option("maxFilesPerTrigger", 1)
    return reader.parquet(place)


#: Rows of all sides in a batch of streams in step: they are the state that a join holds in memory.
STEP_ROWS = 2_000_000


def _in_step(wh: Warehouse, sides: list[tuple[DataFrame, DataFrame, str]], least: int = 3) -> list[DataFrame]:
    """Tables (rows, last rows, time) as streams of the same stretches of time, in order, and a last batch of the last rows.

    Stretches have about equally many rows, however many there are, so what is open between two streams
    follows a stretch and not the table. Rows without a time are left out.
    """
    place = _place(wh, "step")
    tagged = [df.filter(F.col(stamp).isNotNull()).withColumns({"side": F.lit(k), "_at": F.col(stamp)}) for k, (df, _, stamp) in enumerate(sides)]
    every = tagged[0]
    for more in tagged[1:]:
        every = every.unionByName(more, allowMissingColumns=True)
    parts = max(least, -(-every.count() // STEP_ROWS))
    every.repartitionByRange(parts, "_at").drop("_at").write.partitionBy("side").parquet(place)
    streams = []
    for k, (df, end, _) in enumerate(sides):
        folder = f"{place}/side={k}"
        _dated_by_name(wh.spark, folder)
        end.select(*df.columns).coalesce(1).write.mode("append").parquet(folder)
        reader = wh.spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1)
        streams.append(reader.parquet(folder))
    return streams


def _dated_by_name(spark: SparkSession, folder: str) -> None:
    """Give a folder's files past times in the order of their names: a stream reads them in that order."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if files.exists(path):
        found = sorted((s.getPath() for s in files.listStatus(path)), key=lambda p: p.getName())
        now = int(time.time()) - 10
        for k, file in enumerate(found):
            files.setTimes(file, (now - len(found) + k) * 1000, -1)


def _stretch(df: DataFrame, stamp: str, parts: int) -> Column:
    """Which of ``parts`` equal stretches of the table's time a row is in."""
    micros = F.unix_micros(F.col(stamp).cast("timestamp"))
    low, high = df.agg(F.min(micros), F.max(micros)).first()
    return F.expr(f"(unix_micros(CAST({stamp} AS timestamp)) - {low or 0}) * {parts} div {(high or 0) - (low or 0) + 1}")


def _deduplicated(wh: Warehouse) -> tuple[DataFrame, DataFrame]:
    """Events of four stretches; a tenth comes again in the next one, some of the first only in the last."""
    events = wh.source("web_events")
    number = F.substring("event_id", 4, 20).cast("bigint")
    dealt = events.withColumn("part", _stretch(events, "event_timestamp", 4))
    held_back = (F.col("part") == 0) & (number % 50 == 7)
    again = dealt.filter((number % 10 == 0) & (F.col("part") < 3)).withColumn("part", F.col("part") + 1)
    dealt = dealt.withColumn("part", F.when(held_back, F.lit(3)).otherwise(F.col("part"))).unionByName(again)
    place = _place(wh, "dedup")
    days = events.agg(F.datediff(F.max("event_timestamp"), F.min("event_timestamp"))).first()[0]
    stream_events.deduplicate_batches(
        _in_order(wh, dealt, "event_timestamp", "events"),
        place,
        f"{place}/checkpoint",
        "event_id",
        "event_timestamp",
        days // 4 + 2,
    )
    counts = wh.spark.read.parquet(f"{place}/counts")
    late = wh.spark.read.parquet(f"{place}/late").drop("batch")
    return counts.select(F.col("batch").cast("bigint"), "read", "kept", "repeated", "late"), late


def _purchases(wh: Warehouse) -> DataFrame:
    """The log's purchases, and those that some bookings left: most within the hour, some later."""
    logged = wh.table("stg_web_events").filter("event_type = 'PURCHASE'")
    columns = ["event_id", "customer_id", "experience_id", "event_timestamp", "event_type"]
    number = F.substring("booking_id", 2, 20).cast("bigint")
    sold = wh.table("stg_bookings").filter((number % 3 == 0) & F.col("customer_id").isNotNull())
    left = sold.select(
        F.concat(F.lit("EVT-"), "booking_id").alias("event_id"),
        "customer_id",
        "experience_id",
        (F.col("booking_timestamp") + F.make_dt_interval(mins=(number % 80).cast("int") - 10)).alias("event_timestamp"),
        F.lit("PURCHASE").alias("event_type"),
    )
    return logged.select(*columns).unionByName(left)


def _matched_stream(wh: Warehouse, how: str) -> DataFrame:
    """Purchases and bookings as two streams in the order of time, joined."""
    columns = ["booking_id", "customer_id", "experience_id", "booking_timestamp"]
    # Both sides are made from these columns: the deduplicated bookings are worked out once.
    wh.replace("stg_bookings", write_shared(wh.table("stg_bookings").select(*columns), "booked"))
    # Something much later on both sides, as any running stream has: it releases what is unmatched.
    last = F.lit(dt.datetime(2100, 1, 1)).cast("timestamp_ntz")
    closing = wh.spark.range(1).select(F.lit("end").alias("id"), last.alias("at"))
    bought_end = closing.selectExpr("id AS event_id", "id AS customer_id", "id AS experience_id", "at AS event_timestamp", "'PURCHASE' AS event_type")
    booked_end = closing.selectExpr("id AS booking_id", "'no one' AS customer_id", "id AS experience_id", "at AS booking_timestamp")
    sides = [(_purchases(wh), bought_end, "event_timestamp"), (wh.table("stg_bookings"), booked_end, "booking_timestamp")]
    streams = _in_step(wh, sides)
    place = _place(wh, "matched")
    joined = stream_events.matched_purchases(*streams, how=how)
    stream_events.append_to(joined, f"{place}/rows", f"{place}/checkpoint")
    return wh.spark.read.schema(joined.schema).parquet(f"{place}/rows").filter("event_id <> 'end'")


def _unmatched_stream(wh: Warehouse) -> DataFrame:
    return _matched_stream(wh, "leftOuter").filter("booking_id is null").drop("booking_id")


def _booking_stream(wh: Warehouse) -> DataFrame:
    """Deduplicated bookings as a stream over the files they were written to."""
    return _in_batches(wh, wh.table("stg_bookings"), "bookings")


def _tracked_cancellations(wh: Warehouse) -> DataFrame:
    wh.materialise("stg_bookings")  # the stream and the statuses read it
    place = _place(wh, "tracked")
    stream_events.track_cancellations(_booking_stream(wh), f"{place}/rows", f"{place}/checkpoint")
    statuses = wh.table("stg_bookings").select("booking_id", "booking_status")
    return stream_events.tracked_cancellations(wh.spark, f"{place}/rows").join(statuses, "booking_id")


def _enriched_stream(wh: Warehouse) -> DataFrame:
    suppliers = wh.table("stg_suppliers").select("supplier_id", "supplier_name", "supplier_type", "commission_rate", "supplier_status")
    experiences = wh.table("stg_experiences").drop("active_flag")
    # As in the batch details, a booking without a known supplier isn't enriched.
    stream = stream_events.enriched(_booking_stream(wh), experiences.join(suppliers, "supplier_id"))
    stream = stream.select("booking_id", *experiences.columns, *suppliers.drop("supplier_id").columns)
    place = _place(wh, "enriched")
    stream_events.append_to(stream, f"{place}/rows", f"{place}/checkpoint")
    return wh.spark.read.schema(stream.schema).parquet(f"{place}/rows")


def _late_stream(wh: Warehouse) -> DataFrame:
    place = _place(wh, "late")
    late = f"{place}/late"
    stream_events.split_late(
        _booking_stream(wh), f"{place}/in-time", late, f"{place}/checkpoint"
    )
    rows = wh.spark.read.parquet(late)
    return rows.select("booking_id", "booking_timestamp", "experience_date")


def _streamed(build: Callable[[DataFrame], DataFrame]) -> Query:
    """Run the clickstream through ``build`` until the input is used up; read what it wrote."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        stream = build(event_stream(configure(spark), folder))
        place = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
        stream_events.append_to(stream, f"{place}/rows", f"{place}/checkpoint")
        return spark.read.schema(stream.schema).parquet(f"{place}/rows")

    return query


def _stored(
    reduce: Callable[[DataFrame], DataFrame], merge: Callable[[DataFrame], DataFrame]
) -> Query:
    """Store the clickstream's batches, reduced, and merge what is stored."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        wh = open_warehouse(configure(spark), folder)
        place = _place(wh, "stored")
        stream = _in_batches(wh, wh.source("web_events"), "events")
        stream_events.store_batches(stream, f"{place}/rows", f"{place}/checkpoint", reduce)
        return merge(spark.read.parquet(f"{place}/rows"))

    return query


def _approximate_stages(spark: SparkSession, folder: str) -> DataFrame:
    """Whether every approximate count is within five per cent of the exact one."""
    guess = _stored(stream_events.stage_sketches, stream_events.daily_stage_sessions_approx)
    exact = stream_events.daily_stage_sessions(
        stream_events.stage_days(open_warehouse(configure(spark), folder).source("web_events"))
    )
    both = exact.join(
        guess(spark, folder).withColumnRenamed("sessions", "about"), ["day", "event_type"], "full"
    )
    near = F.abs(F.col("sessions") - F.col("about")) <= F.greatest(F.col("sessions") * 0.05, F.lit(1))
    return both.select("day", "event_type", "sessions", F.coalesce(near, F.lit(False)).alias("near"))


def _training_rows(wh: Warehouse) -> DataFrame:
    wh.materialise("ml_rolling_features")
    return training.drop_short_history(training.load_features(wh))


def _split(wh: Warehouse) -> DataFrame:
    return training.split_summary(*training.split_by_time(_training_rows(wh)))


def _baselines(wh: Warehouse) -> DataFrame:
    return training.baseline_scores(training.split_by_time(_training_rows(wh))[1])


def _leaderboard(wh: Warehouse) -> DataFrame:
    return training.fit_all(*training.split_by_time(_training_rows(wh)))[1]


def _fitted_ridge(wh: Warehouse) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """The published ridge, its leaderboard, and the rows it was tested on."""
    train, test = training.split_by_time(_training_rows(wh))
    fitted, board = training.fit_all(train, test, only=["ridge"])
    return fitted["ridge"], board, test


def _ridge_leaderboard(wh: Warehouse) -> DataFrame:
    _, board, test = _fitted_ridge(wh)
    return training.leaderboard(board.unionByName(training.baseline_scores(test)))


def _ridge_weights(wh: Warehouse) -> DataFrame:
    model, _, test = _fitted_ridge(wh)
    return training.feature_weights(model, model.transform(training.as_label(test)))


def _next_day_forecast(wh: Warehouse) -> DataFrame:
    return training.forecast(wh, _fitted_ridge(wh)[0])


def _gate_history(wh: Warehouse) -> DataFrame:
    """Three runs into one registry: a ridge that can only say the mean, the published one, and that again.

    After each run the champion is loaded from its saved pipeline and scored once more.
    """
    train, test = training.split_by_time(_training_rows(wh))
    folder, found = _place(wh, "models"), []
    for run, alpha in (("run-1", 1e12), ("run-2", 1.0), ("run-3", 1.0)):
        fitted, scores = training.fit_all(train, test, training.TrainingOptions(alpha=alpha), ["ridge"])
        decision = training.gate(scores, training.read_registry(wh.spark, folder)).first()
        registry = training.save_run(folder, run, fitted, scores, decision["promote"])
        crowned = registry.filter("is_champion").agg(F.max_by("mae", "trained_at")).first()[0]
        loaded = training.champion(registry).transform(training.as_label(test))
        again = training.score(loaded, training.clipped(), "loaded").first()
        agrees = abs(again["mae"] - crowned) < 1e-9
        had = decision["champion_mae"] is not None
        found.append((run, decision["candidate_name"], had, decision["promote"], agrees, again["n"]))
    schema = "run string, candidate string, had_champion boolean, promoted boolean, loaded_agrees boolean, n_test_rows bigint"
    return wh.spark.createDataFrame(found, schema)
