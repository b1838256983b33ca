"""Landed pages: outcomes, interrupted and exhausted stations, failed chunks that come back alone."""

import json
from datetime import date

from highmark.operators import planning
from highmark.params import RunParams
from highmark.plans.landed import load_chunks, load_history
from highmark.schemas import CHUNK_LEDGER, HISTORY_LEDGER

P = RunParams(as_of=date(2024, 6, 30), min_backfill_year=2000, history_floor_year=1997, empty_stop=2, chunk_days=5)
OBS = "station_id string, obs_date date, tmax double, tmin double, provisional boolean"


def record(station, day, **more):
    return {"indicativo": station, "fecha": day, "tmax": "1,5", **more}


def land(folder, name, rows, cut=0):
    folder.mkdir(parents=True, exist_ok=True)
    text = json.dumps(rows)
    (folder / f"{name}.json").write_text(text[: len(text) - cut])


def test_history_is_resumed_and_ends(spark, tmp_path):
    """a: interrupted by a page that has not landed, then resumed; b: runs dry, with an unreadable page between; c: no page at all; d: nothing before its start."""
    pages = lambda s: tmp_path / f"station={s}"
    land(pages("a"), "1999-07-01", [record("a", "1999-08-01"), record("", "1999-08-02"), record("a", "no day")])
    land(pages("a"), "1998-07-01", [record("a", "1998-08-01")])  # behind the hole: not yet
    land(pages("b"), "1999-07-01", [])
    land(pages("b"), "1999-01-01", [record("b", "1999-02-01"), record("b", "1999-02-02")], cut=9)
    land(pages("b"), "1998-07-01", [record("b", "no day")])
    land(pages("b"), "1998-01-01", [record("b", "1998-03-01")])  # behind the stop: never
    start = date(2000, 1, 1)
    obs = spark.createDataFrame([(s, start, 1.0, None, False) for s in "abc"] + [("d", date(1997, 1, 1), 1.0, None, False)], OBS)
    log = spark.createDataFrame([("d", "started", None, None, 0)], HISTORY_LEDGER)
    first = load_history(spark, str(tmp_path), obs, log, P, 1)
    assert [(r.station_id, r.obs_date.isoformat(), r.tmax, r.provisional, r.seq) for r in first.rows.collect()] == [("a", "1999-08-01", 1.5, False, 1)]
    assert sorted((r.station_id, r.win_start.isoformat(), r.outcome, r.n_rows, r.exhausted) for r in first.pages.collect()) == [
        ("a", "1999-07-01", "loaded", 1, False),
        ("b", "1998-07-01", "empty", 0, True), ("b", "1999-01-01", "failed", 0, False), ("b", "1999-07-01", "empty", 0, False),
    ]
    log = spark.createDataFrame(log.unionByName(first.ledger).collect(), HISTORY_LEDGER)
    state = {r.station_id: (r.complete, r.earliest, r.n_rows) for r in planning.history_ledger(log).collect()}
    assert state == {"a": (False, None, None), "b": (True, None, 0), "c": (False, None, None), "d": (True, None, 0)}

    land(pages("a"), "1999-01-01", [])
    land(pages("a"), "1998-01-01", [record("a", "1998-01-01")])
    land(pages("a"), "1997-07-01", [])
    land(pages("a"), "1997-01-01", [record("a", "1997-01-01")], cut=3)
    # stored in between, as by any run: one plan must not hold both listings of the pages
    now = spark.createDataFrame(obs.unionByName(first.rows.select(obs.columns)).collect(), OBS)
    second = load_history(spark, str(tmp_path), now, log, P, 3)
    assert sorted((r.station_id, r.obs_date.isoformat()) for r in second.rows.collect()) == [("a", "1998-01-01"), ("a", "1998-08-01"), ("a", "1999-08-01")]
    state = {r.station_id: (r.complete, r.earliest, r.n_rows) for r in planning.history_ledger(log.unionByName(second.ledger)).collect()}
    assert state["a"] == (True, date(1998, 1, 1), 3) and state["c"] == (False, None, None)
    chosen = load_history(spark, str(tmp_path), now, log, P, 3, chosen=spark.createDataFrame([("b",)], "station_id string"))
    assert {r.station_id for r in chosen.pages.collect()} == {"b"}


def test_only_failed_chunks_come_back(spark, tmp_path):
    obs = spark.createDataFrame([("a", date(2024, 6, 1), 1.0, None, False)], OBS)
    log = spark.createDataFrame([], CHUNK_LEDGER)
    due = planning.chunks_due(obs, planning.chunk_ledger(log), P)
    starts = [date(2024, 6, d) for d in (2, 7, 12, 17, 22, 27)]
    assert sorted(r.chunk_start for r in due.collect()) == starts
    land(tmp_path, "2024-06-02", [record("a", "2024-06-02"), record("a", "2024-06-04")])
    land(tmp_path, "2024-06-07", [record("a", "2024-06-07")], cut=4)
    land(tmp_path, "2024-06-17", [])
    land(tmp_path, "2024-06-22", [record("a", "2024-06-22"), record("", "2024-06-23")])
    first = load_chunks(spark, str(tmp_path), due, 1)
    told = {r.chunk_start.day: (r.outcome, r.n_rows, r.seq) for r in first.ledger.collect()}
    assert told == {2: ("loaded", 2, 1), 7: ("failed", 0, 1), 12: ("failed", 0, 1), 17: ("empty", 0, 1), 22: ("loaded", 1, 1), 27: ("failed", 0, 1)}
    log = log.unionByName(first.ledger)
    now = spark.createDataFrame(obs.unionByName(first.rows.select(obs.columns)).collect(), OBS)
    log = spark.createDataFrame(log.collect(), CHUNK_LEDGER)
    again = planning.chunks_due(now, planning.chunk_ledger(log), P)
    # the two failed chunks follow each other; after the last definitive day the plan is as ever
    assert sorted((r.chunk_start.day, r.chunk_end.day) for r in again.collect()) == [(7, 11), (12, 16), (23, 27)]
    land(tmp_path, "2024-06-07", [record("a", "2024-06-08")])
    land(tmp_path, "2024-06-12", [])
    second = load_chunks(spark, str(tmp_path), again, 2)
    assert [r.obs_date.day for r in second.rows.collect()] == [8]
    last = planning.chunks_due(now.unionByName(second.rows.select(obs.columns)), planning.chunk_ledger(log.unionByName(second.ledger)), P)
    assert [(r.chunk_start.day, r.chunk_end.day) for r in last.collect()] == [(23, 27)]


def test_history_pages_are_opened_by_name(spark, tmp_path):
    """The driver knows no page: neither those of the plan nor the many of other stations; odd texts are told as a file reader tells them."""
    texts = {
        "1999-07-01": json.dumps([record("a", "1999-08-01")]), "1999-01-01": " \r\n", "1998-07-01": "[null]",
        "1998-01-01": json.dumps(record("a", "1998-02-01")), "1997-07-01": "\ufeff" + json.dumps([record("a", "1997-08-01")]), "1997-01-01": "",
    }
    for station in ("a", "unplanned"):
        folder = tmp_path / f"station={station}"
        folder.mkdir()
        for day, text in texts.items():
            (folder / f"{day}.json").write_text(text)
    (tmp_path / "station=a" / "1999-08-01.json").write_bytes(b"\xff")
    obs = spark.createDataFrame([("a", date(2000, 1, 1), 1.0, None, False), (None, date(2000, 1, 1), 1.0, None, False)], OBS)
    load = load_history(spark, str(tmp_path), obs, spark.createDataFrame([], HISTORY_LEDGER), P, 1)
    for table in (load.rows, load.pages, load.ledger):
        assert not [f for f in table.inputFiles() if f.endswith(".json")]
    assert sorted((r.win_start.isoformat(), r.outcome, r.n_rows) for r in load.pages.collect()) == [
        ("1997-07-01", "loaded", 1), ("1998-01-01", "loaded", 1), ("1998-07-01", "failed", 0), ("1999-01-01", "empty", 0), ("1999-07-01", "loaded", 1),
    ]
    assert sorted(r.obs_date.isoformat() for r in load.rows.collect()) == ["1997-08-01", "1998-02-01", "1999-08-01"]
