"""Pipeline state, load guards and id counters."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from excursio.functions.scalars import id_number
from excursio.schemas import schema_of

_STATE = schema_of("last_loaded_date date, updated_at timestamp_ntz")
# First number of each id series.
BOOKING_BASE, EVENT_BASE = 90_000, 1_000_000


class AlreadyLoaded(Exception):
    """The date has bookings already; loading it again would repeat them."""


def read_or_none(
    spark: SparkSession, path: str, kind: str = "parquet", schema: str | T.StructType | None = None
) -> DataFrame | None:
    """A folder of files, or None while nothing has been written there."""
    reader = spark.read.format(kind)
    try:
        return (reader.schema(schema) if schema else reader).load(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def last_loaded_date(spark: SparkSession, path: str) -> dt.date | None:
    """Latest date in the state log; None before the first load."""
    log = read_or_none(spark, path)
    return log.agg(F.max("last_loaded_date")).first()[0] if log is not None else None


def advance_state(spark: SparkSession, path: str, day: dt.date) -> None:
    """Record ``day`` as loaded.

    The state is a log with one file per date, replaced when a date is repeated, so a crash
    during the write never leaves the pipeline without a state.
    """
    row = spark.createDataFrame([(day,)], "last_loaded_date date")
    stamped = row.withColumn("updated_at", F.current_timestamp().cast("timestamp_ntz"))
    stamped.select(*_STATE.fieldNames()).write.mode("overwrite").parquet(
        f"{path}/loaded={day.isoformat()}"
    )


def refuse_if_loaded(bookings: DataFrame | None, *days: dt.date) -> None:
    """Stop before a second load of one of ``days``; the filter reaches the files."""
    if bookings is None or not days:
        return
    found = bookings.filter(F.col("experience_date").isin(list(days))).select("experience_date").limit(1).collect()
    if found:
        raise AlreadyLoaded(f"{found[0][0]} already has bookings; delete them before loading again")


def next_number(df: DataFrame, column: str, prefix: str, base: int) -> DataFrame:
    """One row ``next_number``: where a new id series continues.

    Ids are prefix + number; suffixes that are not numbers are ignored, an empty table starts
    right after ``base``.
    """
    highest = F.max(id_number(F.col(column), len(prefix)))
    return df.agg((F.coalesce(highest, F.lit(base)) + 1).alias("next_number"))


def active_experiences(dim_experience: DataFrame) -> DataFrame:
    return dim_experience.filter("active_flag").select(
        "experience_id", "experience_name", "city", "category", "capacity", "rating", "base_price"
    )


def customer_ids(dim_customer: DataFrame) -> DataFrame:
    return dim_customer.select("customer_id")
