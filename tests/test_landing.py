"""CSV landing, incremental loads, state and the daily runs."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from excursio.operators.quality import CheckFailed
from excursio.plans import runs
from excursio.sources import commits, landing, state
from excursio.sources.landing import Lake
from tests.conftest import as_dicts, at, booking, event, frames

DAY1, DAY2 = dt.date(2026, 1, 2), dt.date(2026, 1, 3)
SETTINGS = runs.Settings(
    calendar=(dt.date(2025, 12, 1), dt.date(2026, 2, 1)), as_of=dt.date(2026, 3, 1)
)


@pytest.fixture
def lake(tmp_path):
    return Lake(str(tmp_path / "landing"), str(tmp_path / "lake"))


def put(lake, table, day, text, name="part.csv"):
    from pathlib import Path

    folder = Path(lake.files(table)) / f"dt={day.isoformat()}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)


AVAILABILITY = "experience_id,experience_date,time_slot,total_capacity,available_capacity,price\n"


def slots(day, n=2, experience="EXP000001"):
    times = ["09:00", "11:00", "13:00"][:n]
    return "".join(f"{experience},{day},{t},10,6,50.0\n" for t in times)


def csv_of(rows):
    names = list(rows[0])
    lines = [",".join("" if r[n] is None else str(r[n]) for n in names) for r in rows]
    return "\n".join([",".join(names), *lines]) + "\n"


def reordered(rows, table):
    from excursio.schemas import columns

    return [{c: r[c] for c in columns(table)} for r in rows]


def test_null_tokens_quotes_and_rejects(spark, tmp_path):
    text = (
        "supplier_id,supplier_name,country,supplier_type,contract_start_date,"
        "commission_rate,supplier_status\n"
        'SUP1,"Tours, ""Best""",NULL,null,2024-01-05,0.15,ACTIVE\n'
        "SUP2,Plain,,Museum,NULL,NULL,ACTIVE\n"
        "SUP3,Bad rate,France,Museum,2024-01-05,cheap,ACTIVE\n"
        "SUP4,Bad date,France,Museum,05/01/2024,0.2,ACTIVE\n"
        "SUP5,too,few\n"
    )
    path = tmp_path / "suppliers.csv"
    path.write_text(text)
    parsed = landing.parse(landing.read_csv(spark, "suppliers", str(path)), "suppliers").cache()
    good = as_dicts(landing.accepted(parsed), "supplier_id")
    assert [r["supplier_id"] for r in good] == ["SUP1", "SUP2"]
    assert good[0]["supplier_name"] == 'Tours, "Best"'
    assert (good[0]["country"], good[0]["supplier_type"], good[0]["commission_rate"]) == (
        None,
        None,
        0.15,
    )
    assert good[0]["contract_start_date"] == dt.date(2024, 1, 5)
    assert (good[1]["contract_start_date"], good[1]["commission_rate"]) == (None, None)
    reasons = {r["supplier_id"]: r["reason"] for r in landing.rejected(parsed).collect()}
    assert reasons["SUP3"] == "commission_rate: cheap"
    assert reasons["SUP4"] == "contract_start_date: 05/01/2024"
    assert reasons["SUP5"].startswith("line: SUP5,too,few")


def test_whole_numbers_written_as_decimals(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text(AVAILABILITY + "EXP000001,2026-01-02,09:00,10.0,6.5,50\n")
    parsed = landing.parse(landing.read_csv(spark, "availability", str(path)), "availability")
    row = parsed.first()
    assert (row["total_capacity"], row["available_capacity"]) == (10, None)
    assert row["_reasons"] == ["available_capacity: 6.5"]


def test_bulk_load(spark, lake, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text(AVAILABILITY + slots(DAY1) + "EXP000001,never,09:00,1,1,1\n")
    assert landing.read_raw(spark, lake, "availability") is None
    for _ in range(2):
        landing.bulk_load(spark, lake, "availability", str(path))
    assert landing.read_raw(spark, lake, "availability").count() == 2
    assert landing.read_quarantine(spark, lake, "availability").count() == 1


def test_files_are_loaded_once(spark, lake):
    put(lake, "availability", DAY1, AVAILABILITY + slots(DAY1))
    for _ in range(2):
        landing.ingest(spark, lake, "availability", DAY1)
        assert landing.read_raw(spark, lake, "availability").count() == 2
    put(lake, "availability", DAY1, AVAILABILITY + slots(DAY1, 3, "EXP000002"), "late.csv")
    put(lake, "availability", DAY2, AVAILABILITY + slots(DAY2))
    landing.ingest(spark, lake, "availability", DAY1)
    assert landing.read_raw(spark, lake, "availability").count() == 5
    counts = {r["dt"]: r for r in landing.load_reconciliation(spark, lake, "availability").collect()}
    assert counts[DAY1]["complete"] and counts[DAY1]["file_rows"] == 5
    assert not counts[DAY2]["complete"] and counts[DAY2]["loaded_rows"] == 0
    landing.ingest(spark, lake, "availability", DAY2)
    again = landing.load_reconciliation(spark, lake, "availability").filter("not complete")
    assert again.count() == 0


def test_day_by_day_equals_all_days_equals_backfill(spark, tmp_path):
    lakes = [Lake(str(tmp_path / "landing"), str(tmp_path / f"lake{i}")) for i in range(3)]
    for day in (DAY1, DAY2):
        text = AVAILABILITY + slots(day) + f"EXP000001,{day},12:00,x,1,1\n"
        put(lakes[0], "availability", day, text)
    for day in (DAY1, DAY2):
        landing.ingest(spark, lakes[0], "availability", day)
    landing.ingest(spark, lakes[1], "availability", files_per_batch=1)
    end = DAY2 + dt.timedelta(days=1)
    for _ in range(2):
        landing.backfill(spark, lakes[2], "availability", DAY1, end)
    loaded = [
        sorted(landing.read_raw(spark, lk, "availability").collect(), key=str) for lk in lakes
    ]
    assert len(loaded[0]) == 4 and loaded[0] == loaded[1] == loaded[2]
    refused = [
        sorted(r["reason"] for r in spark.read.parquet(lk.quarantine("availability")).collect())
        for lk in lakes
    ]
    assert refused[0] == ["total_capacity: x"] * 2 and refused[0] == refused[1] == refused[2]
    days = spark.read.parquet(lakes[1].raw("availability")).select("dt").distinct()
    assert {r["dt"] for r in days.collect()} == {DAY1, DAY2}


def test_gate_halts_and_the_repaired_files_load_later(spark, lake):
    bad = AVAILABILITY + "EXP000001,2026-01-02,09:00,10,60,50\n"
    put(lake, "availability", DAY1, bad)
    with pytest.raises(CheckFailed, match="available_capacity <= total_capacity"):
        landing.ingest(spark, lake, "availability", DAY1)
    assert landing.read_raw(spark, lake, "availability") is None
    put(lake, "availability", DAY1, AVAILABILITY + slots(DAY1))
    landing.ingest(spark, lake, "availability", DAY1)
    assert landing.read_raw(spark, lake, "availability").count() == 2


def test_gate_can_quarantine_instead(spark, lake):
    put(lake, "availability", DAY1, AVAILABILITY + slots(DAY1) + "EXP000001,2026-01-02,09:00,1,6,5\n")
    landing.ingest(spark, lake, "availability", DAY1, on_violation=landing.QUARANTINE)
    assert landing.read_raw(spark, lake, "availability").count() == 2
    reason = landing.read_quarantine(spark, lake, "availability").first()["reason"]
    assert reason == "rule: available_capacity <= total_capacity"


def test_state_and_counters(spark, lake):
    assert state.last_loaded_date(spark, lake.state) is None
    for day in (DAY1, DAY2, DAY2):
        state.advance_state(spark, lake.state, day)
    assert state.last_loaded_date(spark, lake.state) == DAY2
    assert spark.read.parquet(lake.state).count() == 2
    ids = spark.createDataFrame([("B90009",), ("B9000x",), (None,)], "booking_id string")
    assert state.next_number(ids, "booking_id", "B", 90000).first()[0] == 90010
    none = ids.limit(0)
    assert state.next_number(none, "booking_id", "B", 90000).first()[0] == 90001


def test_written_landing_files_load_back(spark, lake):
    rows = spark.createDataFrame(
        [("EXP000001", DAY1, "09:00", 10, 6, 50.0), ("EXP000001", DAY2, "09:00", 10, None, 9.5)],
        "experience_id string, experience_date date, time_slot string, total_capacity int, "
        "available_capacity int, price double",
    )
    landing.write_landing(rows, lake, "availability", "experience_date")
    landing.ingest(spark, lake, "availability", on_violation=landing.QUARANTINE)
    loaded = landing.read_raw(spark, lake, "availability").collect()
    assert [tuple(r) for r in loaded] == [("EXP000001", DAY1, "09:00", 10, 6, 50.0)]


@pytest.fixture
def stocked(spark, lake, tmp_path):
    """A lake with its catalog loaded and two days of files waiting."""
    catalog = {
        "suppliers": "supplier_id,supplier_name,country,supplier_type,contract_start_date,"
        "commission_rate,supplier_status\nSUP00001,Seine,France,Museum,2024-01-05,0.15,ACTIVE\n",
        "experiences": "experience_id,experience_name,city,country,category,supplier_id,"
        "base_price,capacity,rating,active_flag\n"
        "EXP000001,Walk,Paris,France,Museum,SUP00001,50.0,10,4.6,True\n",
        "customers": "customer_id,signup_date,country,preferred_language,acquisition_channel,"
        "customer_segment\nC1,2025-01-01,USA,English,Organic,Repeat\n",
    }
    for table, text in catalog.items():
        path = tmp_path / f"{table}.csv"
        path.write_text(text)
        landing.bulk_load(spark, lake, table, str(path))
    for i, day in enumerate((DAY1, DAY2)):
        booked = dt.datetime(2025, 12, 20 + i, 10)
        put(lake, "availability", day, AVAILABILITY + slots(day))
        made = [booking(10 * i + n, "C1", "EXP000001", booked, str(day)) for n in (1, 2)]
        put(lake, "bookings", day, csv_of(reordered(made, "bookings")))
        seen = [event(10 * i + 1, f"S{i}", "C1", booked, "PURCHASE", "EXP000001")]
        put(lake, "web_events", day, csv_of(seen))
    return lake


def test_daily_run_guard_and_backfill(spark, stocked, tmp_path):
    first = runs.run_daily(spark, stocked, DAY1, SETTINGS).first()
    assert (first["raw_bookings"], first["bookings"], first["features"]) == (2, 2, 1)
    with pytest.raises(state.AlreadyLoaded):
        runs.run_daily(spark, stocked, DAY1, SETTINGS)
    second = runs.run_daily(spark, stocked, DAY2, SETTINGS).first()
    assert (second["raw_bookings"], second["features"], second["warnings"]) == (4, 2, 0)
    assert state.last_loaded_date(spark, stocked.state) == DAY2

    other = Lake(stocked.landing, str(tmp_path / "other"))
    for table in ("suppliers", "experiences", "customers"):
        landing.bulk_load(spark, other, table, str(tmp_path / f"{table}.csv"))
    end = DAY2 + dt.timedelta(days=1)
    runs.run_backfill(spark, other, DAY1, end, SETTINGS)
    for model in (("marts", "fact_bookings"), ("ml", "ml_demand_features")):
        daily = runs.read_published(spark, stocked, *model)
        bulk = runs.read_published(spark, other, *model)
        assert daily.exceptAll(bulk).count() == bulk.exceptAll(daily).count() == 0


def test_build_stops_at_a_failed_check(spark, stocked, tmp_path):
    path = tmp_path / "suppliers.csv"
    path.write_text(path.read_text().replace("SUP00001", "SUP00002"))
    landing.bulk_load(spark, stocked, "suppliers", str(path))
    with pytest.raises(CheckFailed, match="relationships:supplier_id"):
        runs.run_daily(spark, stocked, DAY1, SETTINGS)
    assert runs.read_published(spark, stocked, "marts", "fact_bookings") is None


def test_backfill_reads_only_its_days(spark, stocked):
    lines = landing.read_csv(spark, "bookings", stocked.files("bookings"), with_day=True)
    plan = lines.filter(F.col("dt") == F.lit(DAY1))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan


def test_one_lake_loads_a_file_once_whichever_way_it_comes(spark, lake):
    end = DAY2 + dt.timedelta(days=1)
    put(lake, "availability", DAY1, AVAILABILITY + slots(DAY1))
    landing.ingest(spark, lake, "availability", DAY1)
    put(lake, "availability", DAY2, AVAILABILITY + slots(DAY2))
    landing.ingest(spark, lake, "availability")
    assert landing.read_raw(spark, lake, "availability").count() == 4
    for _ in range(2):
        landing.backfill(spark, lake, "availability", DAY1, end)
        landing.ingest(spark, lake, "availability", DAY2)
        assert landing.read_raw(spark, lake, "availability").count() == 4
    put(lake, "availability", DAY2, AVAILABILITY + slots(DAY2, 3, "EXP000002"), "late.csv")
    landing.backfill(spark, lake, "availability", DAY2, end)
    landing.ingest(spark, lake, "availability")
    found = landing.load_reconciliation(spark, lake, "availability").orderBy("dt").collect()
    assert [(r["loaded_rows"], r["complete"]) for r in found] == [(2, True), (5, True)]


def test_a_header_in_another_order_stops_the_load(spark, lake):
    swapped = AVAILABILITY.replace("experience_id,experience_date", "experience_date,experience_id")
    put(lake, "availability", DAY1, swapped + f"{DAY1},EXP000001,09:00,10,6,50.0\n")
    with pytest.raises(Exception, match="(?i)header"):
        landing.ingest(spark, lake, "availability", DAY1)
    assert landing.read_raw(spark, lake, "availability") is None


def test_every_table_can_be_ingested(spark, lake):
    from excursio.schemas import RAW_SCHEMAS, columns

    for table in RAW_SCHEMAS:
        if table in ("bookings", "web_events", "availability"):
            continue
        names = columns(table)
        put(lake, table, DAY1, ",".join(names) + "\n" + ",".join(["NULL"] * len(names)) + "\n")
        landing.ingest(spark, lake, table, DAY1)
        assert landing.read_raw(spark, lake, table).count() == 1


def test_quarantine_takes_repeated_bookings(spark, lake):
    rows = reordered(
        [booking(1, "C1", "EXP000001", at("2026-01-01", f"1{k}:00"), "2026-01-02") for k in (1, 0)],
        "bookings",
    )
    put(lake, "bookings", DAY1, csv_of(rows))
    landing.ingest(spark, lake, "bookings", DAY1, on_violation=landing.QUARANTINE)
    kept = landing.read_raw(spark, lake, "bookings").collect()
    assert [r["booking_timestamp"] for r in kept] == [at("2026-01-01", "10:00")]
    assert landing.read_quarantine(spark, lake, "bookings").first()["reason"] == "rule: unique booking_id"


def test_repeats_are_sought_once_for_both_parts(spark, lake, monkeypatch):
    rows = [booking(n, "C1", "EXP000001", at("2026-01-01", f"1{k}:00"), "2026-01-02") for n in range(1, 4) for k in (1, 0)]
    put(lake, "bookings", DAY1, csv_of(reordered(rows, "bookings")))
    write, plans = landing.write_days, []

    def noted(df, *rest):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        write(df, *rest)

    monkeypatch.setattr(landing, "write_days", noted)
    landing.ingest(spark, lake, "bookings", on_violation=landing.QUARANTINE)
    assert len(plans) == 2 and not any("Window" in p for p in plans)  # both read what was gated
    assert landing.read_raw(spark, lake, "bookings").count() == landing.read_quarantine(spark, lake, "bookings").count() == 3


@pytest.mark.parametrize("small", [0, 250_000])
def test_landing_files_are_small_and_whole(spark, lake, monkeypatch, small):
    from pathlib import Path

    rows = [booking(n, f"C{n}", "EXP000001", at("2026-01-01"), "2026-01-02") for n in range(2_000)]
    made = frames(spark, {"bookings": rows})["bookings"]
    monkeypatch.setattr(landing, "SMALL_FILE", small)  # 0: loaded rows aren't gathered
    landing.write_landing(made.repartition(3), lake, "bookings", "experience_date", gather=False)
    files = list(Path(lake.files("bookings")).rglob("part-*"))
    assert len(files) == 3 and sum(f.stat().st_size for f in files) < 60 * len(rows)  # as plain text about 110 bytes a row
    landing.ingest(spark, lake, "bookings", on_violation=landing.QUARANTINE)
    assert landing.read_raw(spark, lake, "bookings").count() == len(rows)


def counts(spark, lake, table="availability"):
    found = landing.load_reconciliation(spark, lake, table).orderBy("dt").collect()
    assert all(r["complete"] for r in found)
    return [r["loaded_rows"] for r in found]


@pytest.mark.parametrize("order", ["backfill first, backfill second, all", "backfill second, day first, backfill both, all"])
def test_several_backfills_and_loads_in_any_order(spark, lake, order):
    put(lake, "availability", DAY1, AVAILABILITY + slots(DAY1))
    put(lake, "availability", DAY2, AVAILABILITY + slots(DAY2, 3))
    end = DAY2 + dt.timedelta(days=1)
    spans = {"first": (DAY1, DAY2), "second": (DAY2, end), "both": (DAY1, end)}
    for step in order.split(", "):
        if step == "all":
            landing.ingest(spark, lake, "availability")
        elif step.startswith("day"):
            landing.ingest(spark, lake, "availability", DAY1)
        else:
            landing.backfill(spark, lake, "availability", *spans[step.split()[1]])
    put(lake, "availability", DAY1, AVAILABILITY + slots(DAY1, 1, "EXP000009"), "more.csv")
    landing.backfill(spark, lake, "availability", *spans["both"])
    landing.backfill(spark, lake, "availability", *spans["first"])
    assert counts(spark, lake) == [3, 3]
    history = landing.load_history(spark, lake, "availability").collect()
    assert sorted((r["_file"].rsplit("/", 2)[1][3:], r["rows"]) for r in history) == [
        (str(DAY1), 1), (str(DAY1), 2), (str(DAY2), 3)
    ]
    assert all(r["_size"] > 0 and r["_modified"] is not None for r in history)


@pytest.mark.parametrize("way", ["backfill", "ingest"])
def test_a_load_that_breaks_off_before_its_commit_leaves_nothing(spark, lake, monkeypatch, way):
    end = DAY2 + dt.timedelta(days=1)
    load = {
        "backfill": lambda: landing.backfill(spark, lake, "availability", DAY1, end),
        "ingest": lambda: landing.ingest(spark, lake, "availability"),
    }[way]
    put(lake, "availability", DAY1, AVAILABILITY + slots(DAY1))
    landing.ingest(spark, lake, "availability", DAY1)
    put(lake, "availability", DAY2, AVAILABILITY + slots(DAY2))
    with monkeypatch.context() as broken:
        def lost(*_, **__):
            raise OSError("the driver is gone")

        broken.setattr(commits.CommitLog, "_rename_into_place", lost)
        with pytest.raises(OSError):
            load()
    assert landing.read_raw(spark, lake, "availability").count() == 2
    landing.ingest(spark, lake, "availability", DAY2)  # another load may bring the files
    assert counts(spark, lake) == [2, 2]
    load()
    assert counts(spark, lake) == [2, 2]
    assert len(landing.remove_unfinished(spark, lake, "availability")) == 1
    assert landing.remove_unfinished(spark, lake, "availability") == []
    assert counts(spark, lake) == [2, 2]


def test_two_loads_side_by_side_do_not_share_a_file(spark, lake, monkeypatch):
    end = DAY2 + dt.timedelta(days=1)
    put(lake, "availability", DAY1, AVAILABILITY + slots(DAY1))
    write, inside = landing.write_days, []

    def meanwhile(df, path):
        if not inside:
            inside.append(1)
            landing.backfill(spark, lake, "availability", DAY1, end)
        write(df, path)

    monkeypatch.setattr(landing, "write_days", meanwhile)
    with pytest.raises(commits.CommitConflict):
        landing.backfill(spark, lake, "availability", DAY1, end)
    assert counts(spark, lake) == [2]


def test_commits_are_numbered_without_gaps(spark, tmp_path):
    log = commits.CommitLog(spark, str(tmp_path / "log"))
    assert log.all() == []
    log.add("a", "la")
    assert not log._rename_into_place("0000000000.json", "{}")
    log.add("b", "lb", replaces=True)
    log.add("c", "lc")
    assert [(c.number, c.name) for c in log.all()] == [(0, "a"), (1, "b"), (2, "c")]
    assert [c.name for c in log.current()] == ["b", "c"]
    with pytest.raises(commits.CommitConflict):
        log.add("a", "again")


def test_a_bulk_load_replaces_once_it_is_committed(spark, lake, tmp_path, monkeypatch):
    path = tmp_path / "availability.csv"
    path.write_text(AVAILABILITY + slots(DAY1))
    landing.bulk_load(spark, lake, "availability", str(path))
    path.write_text(AVAILABILITY + slots(DAY1, 3))
    with monkeypatch.context() as broken:
        broken.setattr(commits.CommitLog, "add", lambda *_, **__: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            landing.bulk_load(spark, lake, "availability", str(path))
    assert landing.read_raw(spark, lake, "availability").count() == 2
    landing.bulk_load(spark, lake, "availability", str(path))
    assert landing.read_raw(spark, lake, "availability").count() == 3


def test_readers_keep_their_build(spark, stocked, monkeypatch):
    runs.run_daily(spark, stocked, DAY1, SETTINGS)
    opened = runs.read_published(spark, stocked, "marts", "fact_bookings")
    landing.ingest(spark, stocked, "bookings", DAY2)
    with monkeypatch.context() as broken:  # marts written, checks not passed
        broken.setitem(runs.LAYERS, "ml", ({"ml_gone": None}, (), ()))
        with pytest.raises(Exception):
            runs.build(runs.open_lake(spark, stocked, SETTINGS), stocked)
    assert runs.read_published(spark, stocked, "marts", "fact_bookings").count() == 2
    runs.build(runs.open_lake(spark, stocked, SETTINGS), stocked)
    assert runs.read_published(spark, stocked, "marts", "fact_bookings").count() == 4
    assert opened.count() == 2
    assert len(runs.remove_old_builds(spark, stocked, keep=1)) == 1
    assert runs.read_published(spark, stocked, "marts", "fact_bookings").count() == 4


def test_backfill_is_guarded(spark, stocked):
    end = DAY2 + dt.timedelta(days=1)
    with pytest.raises(ValueError):
        runs.run_backfill(spark, stocked, DAY2, DAY1, SETTINGS)
    runs.run_daily(spark, stocked, DAY1, SETTINGS)
    again = booking(77, "C1", "EXP000001", dt.datetime(2025, 12, 21, 10), str(DAY1))
    put(stocked, "bookings", DAY1, csv_of(reordered([again], "bookings")), "again.csv")
    with pytest.raises(state.AlreadyLoaded):
        runs.run_backfill(spark, stocked, DAY1, end, SETTINGS)
    summary = runs.run_backfill(spark, stocked, DAY2, end, SETTINGS).first()
    assert summary["raw_bookings"] == 4
