"""Keep-first, ordered groups and joins, against brute force and under skew."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from excursio.operators import joins, measures
from excursio.operators.dedup import keep_first
from excursio.operators.ordered import previous_values, running_total

EVENTS = "key string, at int, id int, amount bigint"


def skewed_rows(seed=7, n=600):
    """A third of the rows share one key, some have none, and order values repeat."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else rng.choice(["a", "b", "c", "d", None])
        rows.append((key, rng.randint(1, 20), i, rng.randint(0, 1)))
    rng.shuffle(rows)
    return rows


def brute_totals(rows):
    totals, expected = {}, {}
    for key, at, number, amount in sorted(rows, key=lambda r: (str(r[0]), r[1], r[2])):
        expected[number] = 0 if key is None else totals.get(key, 0)
        totals[key] = totals.get(key, 0) + amount
    return expected


def brute_previous(rows):
    last, expected = {}, {}
    for key, at, number, amount in sorted(rows, key=lambda r: (str(r[0]), r[1], r[2])):
        expected[number] = (None, None) if key is None else last.get(key, (None, None))
        last[key] = (at, amount)
    return expected


@pytest.mark.parametrize("chunks", [None, 1, 7, 40])
def test_running_total_matches_brute_force(spark, chunks):
    rows = skewed_rows()
    df = spark.createDataFrame(rows, EVENTS).repartition(5)
    got = running_total(df, "key", ["at", "id"], F.col("amount"), "before", chunks)
    assert got.columns == ["key", "at", "id", "amount", "before"]
    assert {r["id"]: r["before"] for r in got.collect()} == brute_totals(rows)


@pytest.mark.parametrize("chunks", [None, 1, 7, 40])
def test_previous_values_match_brute_force(spark, chunks):
    rows = skewed_rows()
    df = spark.createDataFrame(rows, EVENTS).repartition(5)
    new = {"at_before": "at", "amount_before": "amount"}
    got = previous_values(df, "key", ["at", "id"], new, chunks)
    found = {r["id"]: (r["at_before"], r["amount_before"]) for r in got.collect()}
    assert found == brute_previous(rows)


def test_range_path_cuts_the_hot_key_into_many_tasks(spark):
    rows = [("hot", i, i, 1) for i in range(3000)] + [("cold", 1, -1, 1)]
    df = spark.createDataFrame(rows, EVENTS)
    got = running_total(df, "key", ["at", "id"], F.col("amount"), "before", 8)
    assert got.filter("key = 'hot'").agg(F.max("before")).first()[0] == 2999
    assert got.filter("before <> at and key = 'hot'").count() == 0


def test_empty_input(spark):
    df = spark.createDataFrame([], EVENTS)
    assert running_total(df, "key", ["at"], F.col("amount"), "before").count() == 0
    assert previous_values(df, "key", ["at"], {"p": "at"}).count() == 0


def test_keep_first_order_and_ties(spark):
    noon, one = dt.datetime(2026, 1, 1, 12), dt.datetime(2026, 1, 1, 13)
    rows = [
        ("k1", one, "late", 1),
        ("k1", noon, "early", 2),
        ("k2", None, "no time", 1),
        ("k2", one, "timed", 1),
        ("k3", noon, None, 1),
        ("k3", noon, "complete", 9),
        ("k4", noon, "b", 1),
        ("k4", noon, "a", 5),
        (None, noon, "x", 1),
        (None, noon, "x", 1),
    ]
    df = spark.createDataFrame(rows, "id string, at timestamp_ntz, label string, n int")
    got = {r["id"]: r["label"] for r in keep_first(df, ["id"], ["at"]).collect()}
    assert got == {"k1": "early", "k2": "timed", "k3": "complete", "k4": "a", None: "x"}


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(st.sampled_from("abc"), st.integers(0, 3), st.integers(0, 3)),
        min_size=1,
        max_size=12,
    )
)
def test_keep_first_ignores_copies_and_row_order(spark, rows):
    schema = "id string, at int, n int"
    once = keep_first(spark.createDataFrame(rows, schema), ["id"], ["at"]).collect()
    shuffled = list(reversed(rows)) * 2
    again = keep_first(spark.createDataFrame(shuffled, schema), ["id"], ["at"]).collect()
    assert sorted(once) == sorted(again)
    assert sorted(once) == sorted(min(r for r in rows if r[0] == k) for k in {r[0] for r in rows})


def test_keep_first_combines_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 1).alias("id"), F.col("id").alias("at"))
    plan = keep_first(df, ["id"], ["at"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2 and "Partial" in plan and "Aggregate" not in plan


def test_missing_parents_counts_rows_and_passes_nulls(spark):
    child = spark.createDataFrame([("a",), ("a",), ("z",), ("z",), (None,)], "k string")
    parent = spark.createDataFrame([("a",), ("b",)], "p string")
    assert joins.missing_parents(child, ["k"], parent, ["p"]).collect() == [("z", 2)]


def test_split_by_parent_loses_nothing(spark):
    child = spark.createDataFrame([("a", 1), ("z", 2), (None, 3)], "k string, n int")
    parent = spark.createDataFrame([("a",), ("a",)], "k string")
    kept, rejected = joins.split_by_parent(child, parent, "k", "unknown")
    assert [r["n"] for r in kept.collect()] == [1]
    assert sorted(r["n"] for r in rejected.collect()) == [2, 3]


def test_ratio_and_distribution(spark):
    assert spark.range(1).select(measures.ratio(F.lit(1), F.lit(0))).first()[0] is None
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "v string")
    shares = {r["v"]: r["share"] for r in measures.value_distribution(df, "v").collect()}
    assert shares == {"a": 0.5, "b": 0.25, None: 0.25}


def greedy_pairs(left, right, minutes):
    near = sorted(
        (abs((a[3] - b[3]).total_seconds()), a[0], b[0])
        for a in left
        for b in right
        if None not in a and None not in b and a[1:3] == b[1:3] and abs((a[3] - b[3]).total_seconds()) <= 60 * minutes
    )
    out, used = [], set()
    for apart, l, r in near:
        if ("l", l) not in used and ("r", r) not in used:
            used |= {("l", l), ("r", r)}
            out.append((l, r, apart / 60))
    return sorted(out)


@pytest.mark.parametrize("seed", range(3))
def test_rows_are_matched_once(spark, seed):
    draw = random.Random(seed)
    start = dt.datetime(1969, 12, 31, 20)

    def rows(side, n):
        made = []
        for k in range(n):
            when = start + dt.timedelta(minutes=draw.choice([15, 30, 45, 60]) * draw.randint(0, 20))
            made.append([f"{side}{k:03d}", draw.choice("ab"), draw.choice(["x", "y", None]), draw.choice([when, when, None])])
        return [tuple(r) for r in made]

    left, right = rows("l", 60), rows("r", 50)
    schema = "{0}_id string, who string, what string, {0}_time timestamp_ntz"
    a, b = (spark.createDataFrame(r, schema.format(n)) for r, n in ((left, "a"), (right, "b")))
    found = joins.matched_once(a, b, ["who", "what"], "a_id", "b_id", "a_time", "b_time", 45)
    assert sorted(map(tuple, found.collect())) == greedy_pairs(left, right, 45)
    assert joins.matched_once(a.limit(0), b, ["who", "what"], "a_id", "b_id", "a_time", "b_time", 45).count() == 0


def test_a_suite_reads_every_table_once(spark, tmp_path):
    from excursio.operators.quality import Check, summarise

    rows = {
        "parent": ([("a",), ("b",), ("b",), (None,)], "id string"),
        "child": (
            [("a", 1, "x"), ("c", 1, None), ("c", 1, None), ("c", -2, "z"), (None, None, "x"), ("b", None, "x")],
            "id string, n int, kind string",
        ),
    }
    for name, (data, schema) in rows.items():
        spark.createDataFrame(data, schema).write.parquet(str(tmp_path / name))
    tables = lambda name: spark.read.parquet(str(tmp_path / name))
    suite = [
        Check("parent", "unique", ("id",)),
        Check("parent", "not_null", ("id",)),
        Check("child", "unique", ("id",)),
        Check("child", "unique_combination", ("id", "n")),
        Check("child", "unique_combination", ("kind", "n")),
        Check("child", "relationships", ("id",), parent="parent", field="id"),
        Check("child", "accepted_values", ("kind",), values=("x", "y")),
        Check("child", "expression", ("n",), expression="n > 0"),
        Check("child", "not_null", ("n",)),
    ]
    summary = summarise(tables, suite)
    found = {(r["table"], r["check"]): r["violations"] for r in summary.collect()}
    assert list(found.values()) and found == {
        ("parent", "unique:id"): 1,
        ("parent", "not_null:id"): 1,
        ("child", "unique:id"): 1,
        ("child", "unique_combination:id,n"): 1,
        ("child", "unique_combination:kind,n"): 2,
        ("child", "relationships:id"): 3,
        ("child", "accepted_values:kind"): 1,
        ("child", "expression:n"): 1,
        ("child", "not_null:n"): 2,
    }
    for check in suite:
        listed = check.violations(tables)
        n = listed.agg(F.sum("n_rows")).first()[0] if check.kind == "relationships" else listed.count()
        assert (n or 0) == found[(check.table, check.name)]
    plan = summary._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation ") == 2
