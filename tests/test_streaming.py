import json
from datetime import date, timedelta

import pytest

import standins
from highmark.operators.clean import hourly_daily_extremes
from highmark.operators.resolve import resolve_observations
from highmark.sources import readers
from highmark.streaming import intraday


def reading(station, instant, ta, high=None, low=None):
    return {"idema": station, "fint": instant, "ta": ta, "tamax": high, "tamin": low}


def drop(folder, name, *readings):
    (folder / name).write_text(json.dumps(readings))


@pytest.fixture
def folders(tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    return landing, str(tmp_path / "log"), str(tmp_path / "checkpoint")


def run(spark, landing, log, checkpoint):
    stream = readers.stream_hourly(spark, str(landing), max_files=1)
    intraday.ingest_hourly(stream, log, checkpoint, standins.PART).awaitTermination()
    rows = resolve_observations(intraday.read_log(spark, log))
    return sorted((r.station_id, r.obs_date.isoformat(), r.tmax, r.tmin, r.provisional) for r in rows.collect())


def test_stream_equals_batch_over_triggers_and_restarts(spark, folders):
    landing, log, checkpoint = folders
    drop(landing, "1.json", reading("a", "2024-10-26T21:59:00+0000", 5.0), reading("a", "2024-10-26T22:00:00+0000", 6.0, 6.5, None))
    drop(landing, "2.json", reading("a", "2024-10-27T22:59:00+0000", 1.0), reading("b", "2024-10-27T10:00:00+0000", None, None, None))
    run(spark, landing, log, checkpoint)
    drop(landing, "3.json", reading("a", "2024-10-27T12:00:00+0000", 9.0), reading("", "2024-10-27T12:00:00+0000", 99.0))
    got = run(spark, landing, log, checkpoint)
    batch = hourly_daily_extremes(readers.read_hourly(spark, str(landing)), "Europe/Madrid").collect()
    assert got == sorted((r.station_id, r.obs_date.isoformat(), r.tmax, r.tmin, True) for r in batch)
    assert got == [("a", "2024-10-26", 5.0, 5.0, True), ("a", "2024-10-27", 9.0, 1.0, True)]


def test_no_reading_is_too_late_or_too_early(spark, folders):
    landing, log, checkpoint = folders
    drop(landing, "1.json", reading("a", "2024-01-31T12:00:00+0000", 1.0))
    run(spark, landing, log, checkpoint)
    drop(landing, "2.json", reading("a", "2024-01-20T12:00:00+0000", 2.0), reading("a", "2024-01-02T12:00:00+0000", 3.0))
    run(spark, landing, log, checkpoint)
    drop(landing, "3.json", reading("c", "2099-01-01T12:00:00+0000", 4.0))
    run(spark, landing, log, checkpoint)
    drop(landing, "4.json", reading("a", "2024-02-01T12:00:00+0000", 5.0), reading("b", "2024-02-02T12:00:00+0000", 6.0))
    got = run(spark, landing, log, checkpoint)
    batch = hourly_daily_extremes(readers.read_hourly(spark, str(landing)), "Europe/Madrid").collect()
    assert got == sorted((r.station_id, r.obs_date.isoformat(), r.tmax, r.tmin, True) for r in batch)
    assert [r[1] for r in got] == ["2024-01-02", "2024-01-20", "2024-01-31", "2024-02-01", "2024-02-02", "2099-01-01"]


def test_a_new_checkpoint_keeps_earlier_arrivals(spark, folders, tmp_path):
    daily, log = tmp_path / "daily", str(tmp_path / "log")
    daily.mkdir()
    for name, value in (("1", "6,5"), ("2", "7,5")):
        folder = daily / name
        folder.mkdir()
        drop(folder, "1.json", {"indicativo": "a", "fecha": "2024-01-31", "tmax": value}, {"indicativo": "b", "fecha": f"2024-01-0{name}"})
        stream = readers.stream_daily(spark, str(folder))
        intraday.ingest_daily(stream, log, str(tmp_path / f"checkpoint-{name}")).awaitTermination()
    rows = resolve_observations(intraday.read_log(spark, log)).collect()
    assert sorted((r.station_id, r.obs_date.day, r.tmax) for r in rows) == [("a", 31, 7.5), ("b", 1, None), ("b", 2, None)]


def test_truncated_file_fails_the_batch(spark, folders):
    landing, log, checkpoint = folders
    (landing / "1.json").write_text('[{"idema": "a", "fint": "2024-01-31T12:00:00+0000", "ta": 1.0}, {"idema"')
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ_FILE|FAILFAST"):
        run(spark, landing, log, checkpoint)


def test_definitive_batches_supersede(spark, folders, tmp_path):
    landing, log, checkpoint = folders
    drop(landing, "1.json", reading("a", "2024-01-31T12:00:00+0000", 7.0))
    run(spark, landing, log, checkpoint)
    daily = tmp_path / "daily"
    daily.mkdir()
    drop(daily, "1.json", {"indicativo": "a", "fecha": "2024-01-31", "tmax": "6,5", "tmin": "Ip"}, {"indicativo": "a", "fecha": None})
    intraday.ingest_daily(readers.stream_daily(spark, str(daily)), log, str(tmp_path / "checkpoint-daily")).awaitTermination()
    rows = resolve_observations(intraday.read_log(spark, log)).collect()
    assert [(r.tmax, r.tmin, r.provisional) for r in rows] == [(6.5, None, False)]


def live(spark, landing, log, checkpoint, day):
    """Run both queries to the end; progress of the one with state."""
    stream = readers.stream_hourly(spark, str(landing), max_files=1)
    p = standins.replace(standins.PART, as_of=day)
    queries = intraday.ingest_live(stream, log, checkpoint, p)
    for query in queries:
        query.awaitTermination()
    return queries[0].recentProgress


def test_live_state_equals_batch_and_stays_bounded(spark, folders):
    """Triggers over two months: late, early and repeated readings; state holds live days only."""
    landing, log, checkpoint = folders
    most = 0
    for k, day in enumerate((date(2024, 1, 10), date(2024, 1, 11), date(2024, 2, 9), date(2024, 3, 5))):
        at = lambda hour, d=day: f"{d.isoformat()}T{hour:02d}:00:00+0000"
        drop(landing, f"{k}a.json", reading("a", at(10), 5.0 + k), reading("a", at(11), 4.0, 20.0 - k, None), reading("c", "2099-01-01T12:00:00+0000", 4.0))
        drop(landing, f"{k}b.json", reading("a", at(12), 3.0), reading("b", at(12, day - timedelta(12)), 1.0 + k), reading("b", at(12, day - timedelta(40)), 2.0))
        progress = live(spark, landing, log, checkpoint, day)
        state = [s for r in progress for s in r.stateOperators]
        assert all(s.numRowsDroppedByWatermark == 0 for s in state)
        assert state[-1].numRowsTotal <= 5
        most = max(most, *(s.numRowsTotal for s in state))
    assert most > 2
    rows = resolve_observations(intraday.read_log(spark, log)).collect()
    batch = hourly_daily_extremes(readers.read_hourly(spark, str(landing)), "Europe/Madrid").collect()
    key = lambda r: (r.station_id, r.obs_date, r.tmax, r.tmin)
    assert sorted(map(key, rows)) == sorted(map(key, batch)) and len(batch) == 4 + 1 + 8
    seen = {(r.station_id, r.obs_date) for r in intraday.live_view(spark, log).collect()}
    assert ("a", date(2024, 3, 5)) in seen and ("c", date(2099, 1, 1)) not in seen and ("b", date(2024, 1, 25)) not in seen
    assert sum(s.numRowsRemoved for s in state) > 0
