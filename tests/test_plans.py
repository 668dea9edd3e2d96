"""Physical plans: pruning, pushdown, shuffles, skew handling, and no cross joins."""

from __future__ import annotations

import contextlib
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from excursio.plans import business, kpis
from excursio.shared import shared_folder, write_shared
from excursio.sources.star_adapter import open_warehouse

FOLDER = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@contextlib.contextmanager
def settings(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture(scope="module")
def star(spark):
    return open_warehouse(spark, FOLDER)


def test_scans_read_only_needed_columns(star):
    text = plan(kpis.funnel(star))
    assert "props" not in text.split("ReadSchema")[1].split("\n")[0] or "k" in text
    text = plan(star.source("availability").select("experience_id").distinct())
    schema = text.split("ReadSchema: ")[1].split("\n")[0]
    assert "l_partkey" in schema and "l_discount" not in schema and "l_orderkey" not in schema


def test_filters_reach_the_files(spark, star):
    written = write_shared(star.table("dim_experience"), "pushdown")
    text = plan(written.filter("city = 'Brand#7'").select("experience_id"))
    assert "EqualTo(city,Brand#7)" in text
    assert "experience_name" not in text.split("ReadSchema: ")[1].split("\n")[0]


def test_windows_share_one_sort_and_shuffle(star):
    star_plan = plan(star.table("ml_rolling_features"))
    top = star_plan.split("Exchange hashpartitioning(experience_id")[0]
    assert top.count("Window [") == 1 and top.count("Sort [") == 1


def test_daily_grain_needs_no_shuffle_between_aggregate_and_join(spark, star):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        text = plan(star.table("experience_days"))
    # lineitem by slot, its roll-up to days, demand by day, ... but no exchange above the
    # two daily aggregates: both sides already share the partitioning of the left join
    join = text.split("SortMergeJoin [experience_id")
    outer = [part for part in join if "LeftOuter" in part.split("\n")[0]]
    assert outer and "Exchange" not in outer[0].split("HashAggregate")[0]


def test_no_registered_query_uses_a_cartesian_product(spark):
    """Scalar subqueries, not cross joins, bring totals to rows."""
    for name in ("value_distribution", "booking_split_counts", "kpis_all", "price_calendar"):
        text = plan(entry.queries()[name](spark, FOLDER))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_hot_experience_is_split_by_the_skew_join(spark):
    """Two thirds of the rows on one key: adaptive execution reads that partition in pieces."""
    facts = spark.range(0, 60_000, 1, 8).select(
        F.when(F.col("id") % 3 < 2, 7).otherwise(F.col("id")).alias("k"),
        F.sha2(F.col("id").cast("string"), 512).alias("payload"),
    )
    dims = spark.range(0, 60_000, 1, 8).select(F.col("id").alias("k"), F.lit(1).alias("one"))
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="200KB",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="200KB",
        spark__sql__shuffle__partitions="16",
    ):
        per_task = facts.join(dims, "k").groupBy(F.spark_partition_id().alias("task"))
        sizes = per_task.agg(F.count("one").alias("n"), F.max("payload")).collect()
    biggest = max(r["n"] for r in sizes)
    assert sum(r["n"] for r in sizes) == 60_000
    assert biggest < 20_000  # the hot key alone has 40,000 rows


def test_written_copies_live_in_the_shared_folder(spark):
    copy = write_shared(spark.range(3).toDF("n"), "copy")
    assert f"{shared_folder(spark).removeprefix('file:')}/copy-" in copy.inputFiles()[0]
    assert copy.count() == 3


def test_every_query_has_sql_except_model_training_and_approximations():
    without = set(entry.queries()) - set(entry.oracle_sql())
    operators = {q for q in without if q == "pipeline" or re.match(r"op\d+_", q)}
    assert without - operators == {"model_leaderboard", "champion_gate"}
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    rows = entry.entry(spark)
    assert rows.columns == ["city", "revenue"] and rows.count() > 0


def test_number_of_ranges_does_not_matter_on_real_rows(star):
    whole = business.prior_cancellations(star)
    ranged = business.prior_cancellations(star, chunks=6)
    assert whole.exceptAll(ranged).count() == ranged.exceptAll(whole).count() == 0
    steps = business.session_steps(star)
    split = business.session_steps(star, chunks=6)
    assert steps.exceptAll(split).count() == split.exceptAll(steps).count() == 0
