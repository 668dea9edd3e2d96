"""Feature loading, splits, models against closed forms, gate, registry and forecast."""

from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from excursio.plans import training
from excursio.warehouse import Warehouse
from tests.conftest import booking, frames
from verification import registry

QUICK = training.TrainingOptions(
    test_days=10, trees=3, forest_depth=3, rounds=3, boost_depth=2, min_leaf=1
)


@pytest.fixture(scope="module")
def thirty_days(spark):
    start = dt.date(2026, 1, 1)
    rows = [(start + dt.timedelta(days=i), "EXP1001", 1.0, 1.0, i) for i in range(30)]
    return spark.createDataFrame(
        rows,
        "feature_date date, experience_id string, bookings_prev_7d_avg double, "
        "bookings_prev_28d_avg double, target_bookings int",
    )


def test_split_is_chronological_and_complete(thirty_days):
    train, test = training.split_by_time(thirty_days, 7)
    ends = training.split_summary(train, test).collect()
    parts = {r["part"]: r for r in ends}
    last = dt.date(2026, 1, 30) - dt.timedelta(days=7)
    assert parts["train"]["last_day"] <= last < parts["test"]["first_day"]
    assert parts["train"]["n_rows"] + parts["test"]["n_rows"] == 30
    assert parts["test"]["n_rows"] == 7


def test_short_history_is_dropped(spark):
    schema = "bookings_prev_7d_avg double, bookings_prev_28d_avg double, other string"
    rows = [(1.0, 1.0, "a"), (None, 2.0, "b"), (2.0, None, "c")]
    df = spark.createDataFrame(rows, schema)
    assert [r["other"] for r in training.drop_short_history(df).collect()] == ["a"]
    full = df.filter("other = 'a'")
    assert training.drop_short_history(full).count() == 1


def market_rows():
    """Two experiences over 60 days with weekly demand."""
    rng = random.Random(3)
    start = dt.date(2026, 1, 1)
    suppliers = [("SUP1", "One", "France", "Museum", dt.date(2025, 1, 1), 0.1, "ACTIVE")]
    experiences = [
        ("EXP1", "Walk", "Paris", "France", "Museum", "SUP1", 50.0, 10, 4.6, True),
        ("EXP2", "Climb", "Rome", "Italy", "Adventure", "SUP1", 80.0, 5, 4.1, True),
        ("EXP3", "Closed", "Rome", "Italy", "Show", "SUP1", 30.0, 5, 4.1, False),
    ]
    availability, bookings, number = [], [], 0
    for i in range(60):
        day = start + dt.timedelta(days=i)
        for exp, price in (("EXP1", 50.0), ("EXP2", 80.0)):
            availability.append((exp, day, "09:00", 40, 20, price + day.weekday()))
            for _ in range(rng.randint(0, 3) + (3 if day.weekday() >= 5 else 0)):
                number += 1
                booked = dt.datetime(2025, 12, 1, 8)
                bookings.append(booking(number, f"C{number % 7}", exp, booked, str(day)))
    return {
        "suppliers": suppliers,
        "experiences": experiences,
        "customers": [],
        "availability": availability,
        "bookings": bookings,
        "web_events": [],
    }


@pytest.fixture(scope="module")
def demand(spark):
    wh = Warehouse(
        spark,
        frames(spark, market_rows()),
        as_of=dt.date(2026, 4, 1),
        calendar=(dt.date(2025, 12, 1), dt.date(2026, 6, 1)),
    )
    return wh.materialise("experience_days", "ml_base_features")


@pytest.fixture(scope="module")
def parts(demand):
    rows = training.drop_short_history(training.load_features(demand))
    return training.split_by_time(rows, QUICK.test_days)


def test_ridge_equals_the_closed_form(demand, parts):
    train, test = parts
    fitted, _ = training.fit_all(train, test, QUICK, only=["ridge"])
    linear = fitted["ridge"].stages[-1].stages[-1]
    matrix = fitted["ridge"].transform(training.as_label(train))
    rows = matrix.select("varying", training.TARGET).collect()
    x = np.array([r["varying"].toArray() for r in rows])
    y = np.array([r[training.TARGET] for r in rows])
    centred = x - x.mean(axis=0)
    penalty = QUICK.alpha * np.eye(x.shape[1])
    beta = np.linalg.solve(centred.T @ centred + penalty, centred.T @ (y - y.mean()))
    np.testing.assert_allclose(linear.coefficients.toArray(), beta, atol=1e-9)
    expected = y.mean() - x.mean(axis=0) @ beta
    assert linear.intercept == pytest.approx(expected, abs=1e-8)


def test_weights_by_name_give_the_prediction(demand, parts):
    train, test = parts
    model = training.fit_all(train, test, QUICK, only=["ridge"])[0]["ridge"]
    scored = model.transform(training.as_label(test))
    weights = {r["feature"]: r["weight"] for r in training.feature_weights(model, scored).collect()}
    assert {"capacity", "city=Paris", "city=Rome", "month=1", "intercept"} <= set(weights)
    assert weights["quarter=1"] == 0.0  # the same in all training rows
    for row in scored.limit(20).collect():
        numbers = sum(weights[c] * row[c] for c in training.NUMERIC_FEATURES)
        groups = sum(weights.get(f"{c}={row[c]}", 0.0) for c in training.CATEGORICAL_FEATURES)
        assert numbers + groups + weights["intercept"] == pytest.approx(row["prediction"], abs=1e-8)


def test_unseen_category_becomes_zeros(demand, parts):
    train, _ = parts
    from pyspark.ml import Pipeline

    encoder = Pipeline(stages=training.feature_stages()).fit(training.as_label(train))
    strange = training.as_label(train).limit(1).withColumn("city", F.lit("Atlantis"))
    row = encoder.transform(strange).select("city_onehot").first()[0]
    assert row.size == 2 and row.toArray().sum() == 0.0
    known = encoder.transform(training.as_label(train)).select("city_onehot").first()[0]
    assert known.toArray().sum() == 1.0


def test_baselines_and_scores(spark):
    df = spark.createDataFrame(
        [(3, 1, 2.0, 3.0), (5, None, 5.0, 1.0)],
        "target_bookings bigint, bookings_prev_1d bigint, bookings_prev_7d_avg double, "
        "bookings_prev_28d_avg double",
    )
    rows = {r["model"]: r for r in training.baseline_scores(df).collect()}
    assert (rows["last_value"]["mae"], rows["last_value"]["n"]) == (3.5, 2)
    assert (rows["mean_7d"]["mae"], rows["mean_7d"]["rmse"]) == (0.5, 0.707)


def test_leaderboard_gate_registry_and_forecast(spark, demand, parts, tmp_path):
    fitted, scores = training.fit_all(*parts, options=QUICK)
    board = scores.collect()
    assert {r["model"] for r in board} == {"gradient_boosting", "random_forest", "ridge"}
    assert [r["mae"] for r in board] == sorted(r["mae"] for r in board)
    assert training.best_model(scores).first()["model"] == board[0]["model"]

    folder = str(tmp_path / "models")
    assert training.read_registry(spark, folder) is None
    first = training.gate(scores, None).first()
    assert first["promote"] is True and first["champion_mae"] is None
    registry = training.save_run(folder, "1", fitted, scores, True)
    assert registry.count() == 3 and registry.filter("is_champion").count() == 1
    same = training.gate(scores, registry).first()
    assert same["promote"] is False and same["champion_mae"] == board[0]["mae"]
    better = scores.withColumn("mae", F.col("mae") - 0.001)
    assert training.gate(better, registry).first()["promote"] is True
    registry = training.save_run(folder, "2", fitted, scores, False)
    registry = training.save_run(folder, "2", fitted, scores, False)
    assert registry.count() == 6 and registry.filter("is_champion").count() == 1

    predicted = training.forecast(demand, training.champion(registry)).collect()
    assert {r["experience_id"] for r in predicted} == {"EXP1", "EXP2"}
    assert {r["feature_date"] for r in predicted} == {dt.date(2026, 3, 2)}
    assert all(r["predicted_bookings"] >= 0 for r in predicted)

    forest = fitted["random_forest"]
    encoded = forest.transform(training.as_label(parts[0]))
    weights = {r[0]: r[1] for r in training.feature_importance(forest, encoded).collect()}
    assert sum(weights.values()) == pytest.approx(1.0)
    assert set(weights) <= set(training.NUMERIC_FEATURES + training.CATEGORICAL_FEATURES)


def test_no_champion(spark):
    registry = spark.createDataFrame(
        [], "path string, mae double, trained_at timestamp_ntz, is_champion boolean"
    )
    with pytest.raises(LookupError):
        training.champion(registry)


def test_next_day_features_continue_the_history(demand):
    rows = {r["experience_id"]: r for r in training.next_day_features(demand).collect()}
    last = demand.table("ml_base_features").filter("feature_date = date '2026-03-01'")
    target = {r["experience_id"]: r["target_bookings"] for r in last.collect()}
    assert rows["EXP1"]["bookings_prev_1d"] == target["EXP1"]
    assert rows["EXP1"]["days_of_prior_history"] == 60
    assert rows["EXP1"]["target_bookings"] is None
    assert rows["EXP1"]["avg_price"] == 45.0  # March, a Monday


def test_train_and_gate_end_to_end(spark, demand, tmp_path):
    from excursio.plans import runs
    from excursio.sources.landing import Lake

    lake = Lake(str(tmp_path / "landing"), str(tmp_path / "lake"))
    for run, promoted in (("1", True), ("2", False)):
        forecast, summary = runs.train_and_gate(demand, lake, run, QUICK, only=["ridge"])
        assert summary.first()["promote"] is promoted
        assert forecast.count() == 2


def test_registered_leaderboard_fits_the_published_models(monkeypatch, demand, parts):
    seen = []

    def fit_all(train, test, options=training.TrainingOptions(), only=None):
        seen.append((options, only))
        return {}, None

    monkeypatch.setattr(training, "fit_all", fit_all)
    monkeypatch.setattr(registry, "_training_rows", lambda wh: parts[0])
    registry._leaderboard(demand)
    assert seen == [(training.TrainingOptions(), None)]
    assert (seen[0][0].trees, seen[0][0].forest_depth) == (300, 10)
    assert (seen[0][0].rounds, seen[0][0].boost_depth) == (300, 5)


def test_fitting_keeps_no_copy_of_the_matrix(monkeypatch, parts):
    def persist(frame, *level):
        raise AssertionError("the encoded matrix is kept")

    for name in ("persist", "cache"):
        monkeypatch.setattr(type(parts[0]), name, persist)
    fitted, scores = training.fit_all(*parts, options=QUICK, only=["ridge"])
    assert set(fitted) == {"ridge"} and scores.first()["n"] > 0
