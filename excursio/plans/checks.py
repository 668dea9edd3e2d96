"""The declared checks of every model, the batch gate, contract checks and defect profile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from excursio.functions import rules
from excursio.operators import quality
from excursio.operators.joins import missing_parents, union_all
from excursio.operators.measures import row_count
from excursio.operators.quality import ERROR, WARN, Check
from excursio.plans.business import bookings_without_inventory, session_order_violations
from excursio.schemas import (
    BOOKING_STATUSES,
    CUSTOMER_SEGMENTS,
    FUNNEL_STAGES,
    ORPHAN_REASON,
    SUPPLIER_STATUSES,
    columns,
)
from excursio.shared import write_shared
from excursio.warehouse import Warehouse


def _key(table: str, column: str) -> list[Check]:
    return [Check(table, "unique", (column,)), Check(table, "not_null", (column,))]


def _references(table: str, column: str, parent: str, severity: str = ERROR) -> Check:
    return Check(
        table, "relationships", (column,), severity, parent=parent, field=column
    )


def _holds(table: str, column: str, condition: str, severity: str = ERROR) -> Check:
    return Check(table, "expression", (column,), severity, expression=f"{column} {condition}")


def _accepts(table: str, column: str, values: tuple[str, ...]) -> Check:
    return Check(table, "accepted_values", (column,), values=values)


def _grain(table: str, *names: str) -> Check:
    return Check(table, "unique_combination", names)


STAGING_CHECKS = [
    *_key("stg_suppliers", "supplier_id"),
    _accepts("stg_suppliers", "supplier_status", SUPPLIER_STATUSES),
    *_key("stg_experiences", "experience_id"),
    _references("stg_experiences", "supplier_id", "stg_suppliers"),
    _holds("stg_experiences", "base_price", "> 0"),
    *_key("stg_customers", "customer_id"),
    _accepts("stg_customers", "customer_segment", CUSTOMER_SEGMENTS),
    _references("stg_availability", "experience_id", "stg_experiences"),
    _grain("stg_availability", "experience_id", "experience_date", "time_slot"),
    *_key("stg_bookings", "booking_id"),
    Check("stg_bookings", "not_null", ("customer_id",), WARN),
    _references("stg_bookings", "experience_id", "stg_experiences", WARN),
    _accepts("stg_bookings", "booking_status", BOOKING_STATUSES),
    _holds("stg_bookings", "booking_amount", ">= 0", WARN),
    *_key("stg_web_events", "event_id"),
    _references("stg_web_events", "customer_id", "stg_customers"),
    _accepts("stg_web_events", "event_type", FUNNEL_STAGES),
]
INTERMEDIATE_CHECKS = [
    *_key("int_booking_details", "booking_id"),
    _references("int_booking_details", "experience_id", "stg_experiences"),
    _references("int_booking_details", "supplier_id", "stg_suppliers"),
    *_key("int_orphaned_bookings", "booking_id"),
    _accepts("int_orphaned_bookings", "orphan_reason", (ORPHAN_REASON,)),
    *_key("int_customer_activity", "customer_id"),
    _holds("int_customer_activity", "total_bookings", ">= 0"),
    _holds("int_customer_activity", "confirmed_bookings", "<= total_bookings"),
    _references("int_experience_daily_metrics", "experience_id", "stg_experiences"),
    _grain("int_experience_daily_metrics", "experience_id", "experience_date"),
]
MART_CHECKS = [
    *_key("dim_customer", "customer_id"),
    *_key("dim_supplier", "supplier_id"),
    *_key("dim_experience", "experience_id"),
    _holds("dim_experience", "rating", "between 0 and 5"),
    _references("dim_experience", "supplier_id", "dim_supplier"),
    *_key("dim_date", "date_day"),
    *_key("fact_bookings", "booking_id"),
    _references("fact_bookings", "customer_id", "dim_customer", WARN),
    _references("fact_bookings", "experience_id", "dim_experience"),
    _references("fact_bookings", "date_day", "dim_date"),
    _holds("fact_bookings", "number_of_guests", ">= 1"),
    *_key("fact_web_events", "event_id"),
    _references("fact_web_events", "customer_id", "dim_customer"),
    _references("fact_web_events", "date_day", "dim_date"),
    _references("fact_experience_availability", "experience_id", "dim_experience"),
    _references("fact_experience_availability", "date_day", "dim_date"),
    _grain("fact_experience_availability", "experience_id", "date_day", "time_slot"),
]
FEATURE_CHECKS = [
    _references("ml_daily_price", "experience_id", "dim_experience"),
    _grain("ml_daily_price", "experience_id", "date_day"),
    _references("ml_base_features", "experience_id", "dim_experience"),
    Check("ml_base_features", "not_null", ("target_bookings",)),
    _grain("ml_base_features", "experience_id", "feature_date"),
    _holds("ml_rolling_features", "days_of_prior_history", ">= 0"),
    _grain("ml_rolling_features", "experience_id", "feature_date"),
    _references("ml_demand_features", "experience_id", "dim_experience"),
    Check("ml_demand_features", "not_null", ("target_bookings",)),
    _grain("ml_demand_features", "experience_id", "feature_date"),
]
SECTIONS = (STAGING_CHECKS, INTERMEDIATE_CHECKS, MART_CHECKS, FEATURE_CHECKS)
MODEL_CHECKS = [check for section in SECTIONS for check in section]

# Models many checks read; written once before a suite runs instead of recomputed per check.
# Each stage needs only the stages before it.
SHARED_MODELS = (
    ("stg_experiences", "stg_availability", "stg_bookings", "stg_web_events"),
    ("int_booking_details", "int_orphaned_bookings"),
    ("experience_days", "int_customer_activity"),
    ("ml_rolling_features",),
)


def split_counts(wh: Warehouse) -> DataFrame:
    """One row: bookings in staging, in details and in the orphan queue."""
    staging = wh.table("stg_bookings").agg(row_count("staging_row_count"))
    details = wh.table("int_booking_details").agg(row_count()).scalar()
    orphans = wh.table("int_orphaned_bookings").agg(row_count()).scalar()
    return staging.select(
        "staging_row_count",
        details.alias("details_row_count"),
        orphans.alias("orphan_row_count"),
        (details + orphans).alias("split_row_count"),
    )


def split_violation(wh: Warehouse) -> DataFrame:
    """The conservation test: a row only when details and orphans do not add up to staging."""
    lost = F.col("staging_row_count") != F.col("split_row_count")
    return split_counts(wh).filter(lost).select("staging_row_count", "split_row_count")


def unaccounted_bookings(wh: Warehouse) -> DataFrame:
    """Bookings in neither the details nor the orphan queue (experience without supplier)."""
    details = wh.table("int_booking_details").select("booking_id")
    orphans = wh.table("int_orphaned_bookings").select("booking_id")
    placed = details.unionByName(orphans)
    return wh.table("stg_bookings").select("booking_id").join(placed, "booking_id", "left_anti")


def check_models(wh: Warehouse) -> DataFrame:
    """Summary of all declared checks plus the conservation test.

    Section after section is counted and its few rows kept, so the keys of one section only are on
    disk at a time.
    """
    wh.materialise_stages(SHARED_MODELS)
    conservation = split_violation(wh).agg(row_count("violations"))
    labels = {
        "check": "booking_split_conserves_rows",
        "table": "stg_bookings",
        "column": "booking_id",
        "severity": ERROR,
    }
    declared = union_all([write_shared(quality.summarise(wh.table, section), "checks") for section in SECTIONS])
    return declared.unionByName(quality.labelled(conservation, **labels))


def gate_rules(table: str) -> dict[str, Column]:
    """Row-level batch rules of one table; NULL fails."""
    if table == "bookings":
        return {"booking_amount >= 0": quality.not_true(F.col("booking_amount") >= 0)}
    if table == "availability":
        fits = F.col("available_capacity") <= F.col("total_capacity")
        return {
            "available_capacity <= total_capacity": quality.not_true(fits),
            "total_capacity >= 0": quality.not_true(F.col("total_capacity") >= 0),
        }
    if table == "web_events":
        return {
            "known event_type": quality.not_true(F.col("event_type").isin(*FUNNEL_STAGES)),
            "session_id present": F.col("session_id").isNull(),
        }
    return {}


def gate_batch(table: str, batch: DataFrame) -> DataFrame:
    """Pre-load gate of one table's batch: (table, rule, violations); empty batches pass."""
    summary = quality.counted(batch, gate_rules(table), table=table)
    if table == "bookings":
        repeated = quality.repeated_rows(batch, "booking_id")
        labels = {"table": table, "rule": "unique booking_id"}
        summary = summary.unionByName(quality.labelled(repeated, **labels))
    return summary


def gate_all(wh: Warehouse) -> DataFrame:
    batches = ("bookings", "availability", "web_events")
    return union_all([gate_batch(t, wh.source(t)) for t in batches])


def contract_checks(wh: Warehouse) -> DataFrame:
    """Reference-table contracts: (dataset, rule, violations). Missing columns raise first."""
    suppliers, experiences, customers = (
        wh.source(t) for t in ("suppliers", "experiences", "customers")
    )
    for name in ("suppliers", "experiences", "customers"):
        missing = quality.missing_columns(wh.source(name), columns(name))
        if missing:
            raise ValueError(f"missing {name} columns: {missing}")
    status, segment = F.col("supplier_status"), F.col("customer_segment")
    parts = [
        quality.counted(
            suppliers,
            {
                "supplier_id present": F.col("supplier_id").isNull(),
                "commission_rate in 0..1": quality.outside_range("commission_rate", 0, 1),
                "known supplier_status": ~status.isin(*SUPPLIER_STATUSES),
            },
            dataset="suppliers",
        ),
        quality.counted(
            experiences,
            {
                "experience_id present": F.col("experience_id").isNull(),
                "base_price positive": F.col("base_price") <= 0,
                "capacity positive": F.col("capacity") <= 0,
                "rating in 1..5": quality.outside_range("rating", 1, 5),
            },
            dataset="experiences",
        ),
        quality.counted(
            customers,
            {
                "customer_id present": F.col("customer_id").isNull(),
                "known customer_segment": ~segment.isin(*CUSTOMER_SEGMENTS),
                "signup_date present": F.col("signup_date").isNull(),
            },
            dataset="customers",
        ),
    ]
    for dataset, frame, key in (
        ("suppliers", suppliers, "supplier_id"),
        ("experiences", experiences, "experience_id"),
        ("customers", customers, "customer_id"),
    ):
        repeated = quality.repeated_rows(frame, key)
        parts.append(quality.labelled(repeated, dataset=dataset, rule=f"unique {key}"))
    unknown = quality.unknown_values(experiences, "supplier_id", suppliers, "supplier_id")
    parts.append(
        quality.labelled(
            unknown.agg(row_count("violations")), dataset="experiences", rule="known supplier_id"
        )
    )
    return union_all(parts)


def raise_if_invalid(summary: DataFrame, label: str) -> None:
    """Raise once, listing every rule that has violations."""
    broken = summary.filter("violations > 0").collect()  # one row per rule at most
    if broken:
        lines = "\n".join(f"- {row['rule']}: {row['violations']}" for row in broken)
        raise ValueError(f"{label} validation failed:\n{lines}")


def invariants(wh: Warehouse) -> DataFrame:
    """The six cross-table invariants: (invariant, violations)."""
    wh.materialise("stg_bookings")  # three of them read it

    def orphans(child: str, column: str, parent: str) -> DataFrame:
        found = missing_parents(wh.table(child), [column], wh.table(parent), [column])
        return found.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("violations"))

    available, total = F.col("available_capacity"), F.col("total_capacity")
    in_bounds = quality.not_true((available >= 0) & (available <= total))
    capacity = wh.table("stg_availability").agg(F.count_if(in_bounds).alias("violations"))
    no_inventory = bookings_without_inventory(wh).agg(row_count("violations"))
    parts = {
        "booking customer exists": orphans("stg_bookings", "customer_id", "stg_customers"),
        "booking experience exists": orphans("stg_bookings", "experience_id", "stg_experiences"),
        "experience supplier exists": orphans("stg_experiences", "supplier_id", "stg_suppliers"),
        "booking day has inventory": no_inventory,
        "event customer exists": orphans("stg_web_events", "customer_id", "stg_customers"),
        "available capacity in bounds": capacity,
    }
    return union_all([quality.labelled(df, invariant=name) for name, df in parts.items()])


def defect_profile(wh: Warehouse) -> DataFrame:
    """One row per known defect kind: (defect, n_rows).

    Repeated ids are counted on the raw tables, everything else after deduplication.
    """
    bookings = wh.table("stg_bookings")
    late = rules.is_late(F.col("booking_timestamp"), F.col("experience_date"))
    rows = quality.counted(
        bookings,
        {
            "null_customer": F.col("customer_id").isNull(),
            "negative_amount": F.col("booking_amount") < 0,
            "late_booking": late,
        },
    ).select(F.col("rule").alias("defect"), F.col("violations").alias("n_rows"))
    unknown = missing_parents(
        bookings, ["experience_id"], wh.table("stg_experiences"), ["experience_id"]
    ).agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"))
    disordered = session_order_violations(wh).agg(
        F.countDistinct("session_id").alias("n_rows")
    )
    repeats = {
        "duplicate_booking": quality.repeated_rows(wh.source("bookings"), "booking_id"),
        "duplicate_event": quality.repeated_rows(wh.source("web_events"), "event_id"),
    }
    parts = [
        rows,
        quality.labelled(unknown, defect="unknown_experience"),
        quality.labelled(disordered, defect="out_of_order_session"),
        *[
            quality.labelled(df.withColumnRenamed("violations", "n_rows"), defect=name)
            for name, df in repeats.items()
        ],
    ]
    return union_all(parts)


def row_counts(wh: Warehouse, names: tuple[str, ...]) -> DataFrame:
    """Load audit: (table, n_rows) of the raw tables."""
    counts = [quality.labelled(wh.source(n).agg(row_count("n_rows")), table=n) for n in names]
    return union_all(counts)
