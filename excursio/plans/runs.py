"""The daily run, the backfill, and train-and-gate as plain functions."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from excursio.operators import quality
from excursio.operators.measures import row_count
from excursio.plans import checks, features, intermediate, marts, staging, training
from excursio.schemas import DAILY_TABLES, RAW_SCHEMAS
from excursio.sources.commits import CommitLog, delete
from excursio.sources.landing import Lake, backfill, ingest, pending_days, read_raw
from excursio.sources.state import advance_state, refuse_if_loaded
from excursio.warehouse import CALENDAR_END, CALENDAR_START, Warehouse

# Layers in build order: their models, the often-read models to write (in stages), the checks.
LAYERS = {
    "staging": (
        staging.MODELS,
        (("stg_availability", "stg_bookings", "stg_web_events"),),
        checks.STAGING_CHECKS,
    ),
    "intermediate": (
        intermediate.MODELS,
        (("int_booking_details", "int_orphaned_bookings"), ("experience_days", "int_customer_activity")),
        checks.INTERMEDIATE_CHECKS,
    ),
    "marts": (marts.MODELS, (), checks.MART_CHECKS),
    "ml": (features.MODELS, (), checks.FEATURE_CHECKS),
}
WRITTEN_LAYERS = ("marts", "ml")


@dataclass(frozen=True)
class Settings:
    calendar: tuple[dt.date, dt.date] = (CALENDAR_START, CALENDAR_END)
    as_of: dt.date | None = None


def open_lake(spark: SparkSession, lake: Lake, settings: Settings = Settings()) -> Warehouse:
    """Warehouse over the loaded raw tables; a table never loaded is empty."""

    def opener(table: str):
        def opened() -> DataFrame:
            loaded = read_raw(spark, lake, table)
            return spark.createDataFrame([], RAW_SCHEMAS[table]) if loaded is None else loaded

        return opened

    raw = {table: opener(table) for table in RAW_SCHEMAS}
    return Warehouse(spark, raw, as_of=settings.as_of, calendar=settings.calendar)


def build(wh: Warehouse, lake: Lake) -> list:
    """Build every layer, check it, and stop at the first layer with a failed ``error`` check.

    Staging and intermediate models stay views over a few written tables; marts and features
    are written in full, to a folder of this build, and published together by one commit when all
    checks have passed. Until then, and if the build breaks off, readers see the build before; one
    that has opened a table keeps reading its own build. Returns the ``warn`` findings.
    """
    warnings = []
    folder = f"build-{uuid.uuid4().hex}"
    for layer, (models, shared, layer_checks) in LAYERS.items():
        wh.materialise_stages(shared)
        if layer in WRITTEN_LAYERS:
            for name in models:
                path = f"{lake.builds}/{folder}/{layer}/{name}"
                wh.table(name).write.parquet(path)
                wh.replace(name, wh.spark.read.parquet(path))
        warnings += quality.enforce(quality.summarise(wh.table, layer_checks))
        if layer == "intermediate":
            checks.raise_if_invalid(_conservation(wh), "booking split")
    CommitLog(wh.spark, lake.published).add(folder, folder)
    return warnings


def read_published(spark: SparkSession, lake: Lake, layer: str, name: str) -> DataFrame | None:
    """A mart or feature table of the latest published build, None before the first."""
    builds = CommitLog(spark, lake.published).all()
    return spark.read.parquet(f"{lake.builds}/{builds[-1].label}/{layer}/{name}") if builds else None


def remove_old_builds(spark: SparkSession, lake: Lake, keep: int = 3) -> list[str]:
    """Delete all published builds but the last ``keep``, which readers may still have open."""
    old = [c.label for c in CommitLog(spark, lake.published).all()][: -max(keep, 1)]
    for folder in old:
        delete(spark, f"{lake.builds}/{folder}")
    return old


def _conservation(wh: Warehouse) -> DataFrame:
    counted = checks.split_violation(wh).agg(row_count("violations"))
    return quality.labelled(counted, rule="details and orphans add up to staging")


def run_daily(
    spark: SparkSession,
    lake: Lake,
    day: dt.date,
    settings: Settings = Settings(),
    tables: Sequence[str] = DAILY_TABLES,
) -> DataFrame:
    """Guard, gate and load one day, advance the state, rebuild; returns the run summary."""
    refuse_if_loaded(read_raw(spark, lake, "bookings"), day)
    for table in tables:
        ingest(spark, lake, table, day)
    advance_state(spark, lake.state, day)
    wh = open_lake(spark, lake, settings)
    warnings = build(wh, lake)
    return run_summary(wh, day, warnings)


def run_backfill(
    spark: SparkSession,
    lake: Lake,
    start: dt.date,
    end: dt.date,
    settings: Settings = Settings(),
    tables: Sequence[str] = DAILY_TABLES,
) -> DataFrame:
    """Load the days [start, end) in one job per table, then rebuild once.

    Files that a run before has loaded are left out. New booking files for a day that has bookings
    already are refused, as a daily run refuses them.
    """
    if start >= end:
        raise ValueError(f"no day from {start} up to {end}")
    refuse_if_loaded(read_raw(spark, lake, "bookings"), *pending_days(spark, lake, "bookings", start, end))
    for table in tables:
        backfill(spark, lake, table, start, end)
    last = end - dt.timedelta(days=1)
    advance_state(spark, lake.state, last)
    wh = open_lake(spark, lake, settings)
    warnings = build(wh, lake)
    return run_summary(wh, last, warnings)


def run_summary(wh: Warehouse, day: dt.date, warnings: list) -> DataFrame:
    """One audit row: what is loaded, what was built, what was warned about."""
    counts = {
        "raw_bookings": wh.source("bookings"),
        "bookings": wh.table("fact_bookings"),
        "orphans": wh.table("int_orphaned_bookings"),
        "features": wh.table("ml_demand_features"),
    }
    scalars = [df.agg(row_count()).scalar().alias(name) for name, df in counts.items()]
    return wh.spark.range(1).select(
        F.lit(day).alias("day"),
        *scalars,
        F.lit(len(warnings)).alias("warnings"),
    )


def train_and_gate(
    wh: Warehouse,
    lake: Lake,
    run: str,
    options: training.TrainingOptions = training.TrainingOptions(),
    only: Sequence[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Train, score, gate, save, and forecast the next day with the resulting champion.

    Returns (forecast, run summary: candidate, champion error before, promoted flag).
    """
    rows = training.drop_short_history(training.load_features(wh))
    train, test = training.split_by_time(rows, options.test_days)
    fitted, scores = training.fit_all(train, test, options, only)
    registry = training.read_registry(wh.spark, lake.models)
    decision = training.gate(scores, registry).first().asDict()
    updated = training.save_run(lake.models, run, fitted, scores, decision["promote"])
    schema = (
        "candidate_name string, candidate_mae double, champion_mae double, promote boolean, "
        "run string"
    )
    summary = wh.spark.createDataFrame([{**decision, "run": run}], schema)
    return training.forecast(wh, training.champion(updated)), summary
