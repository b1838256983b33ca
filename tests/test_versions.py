"""The versioned store: what a run writes, reads and publishes."""

import os
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

import naive
from highmark.operators import ladder
from highmark.params import RunParams
from highmark.plans import incremental
from highmark.schemas import EVENT_COLUMNS
from highmark.sources import versions

LOG = "station_id string, obs_date date, tmed double, tmin double, tmax double, horatmin string, horatmax string, prec double, sol double, hr_media double, vel_media double, pres_max double, pres_min double, provisional boolean, seq long"
FIRST, LAST = date(2001, 1, 1), date(2004, 3, 1)


def value(station, day):
    return float((day.toordinal() * (7919 + 2 * station)) % 101)


def log(spark, days, seq, stations=range(4), provisional=False, shift=0.0):
    none = [None] * 6
    rows = [
        (f"s{s}", d, None, value(s, d) - 50 + shift, value(s, d) + shift, None, None, *none, provisional, seq)
        for s in stations for d in days
    ]
    return spark.createDataFrame(rows, LOG)


def p(day):
    return RunParams(as_of=day, warmup_days=200)


def tree(base, table):
    return {os.path.relpath(os.path.join(at, f), base): os.stat(os.path.join(at, f)).st_mtime_ns for at, _, files in os.walk(f"{base}/{table}") for f in files if f.endswith(".parquet")}


def is_full(cycle, day):
    rows = [(r["station_id"], r["obs_date"], r["tmax"], r["tmin"], r["provisional"]) for r in cycle.observations.collect()]
    got = sorted((tuple(r) for r in cycle.record_events.select(*EVENT_COLUMNS).collect()), key=repr)
    return got == naive.ladder(rows, 200)


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("store"))
    first = incremental.run_cycle(spark, base, log(spark, naive.day_range(FIRST, (LAST - FIRST).days), 0), p(LAST), buckets=4)
    return base, first


def test_steps_of_a_store(spark, store, monkeypatch):
    base, first = store
    assert versions.current(base) == first.version and is_full(first, LAST)
    assert first.record_events_new.count() == 0
    before = tree(base, "observations")

    # 1. days that follow: only their year is written, and only it and the settled day's year are read
    asked, read = [], versions.read_pieces
    monkeypatch.setattr(versions, "read_pieces", lambda s, b, table, held, schema, parts=None: (asked.append(parts) if table == "observations" else None, read(s, b, table, held, schema, parts))[1])
    day = LAST + timedelta(20)
    new_days = naive.day_range(LAST, 21)
    arriving = log(spark, new_days[:-3], 1).unionByName(log(spark, new_days[-3:], 1, provisional=True, shift=60.0))
    second = incremental.run_cycle(spark, base, arriving, p(day), buckets=4)
    within_run, monkeypatch_done = asked[:-1], monkeypatch.undo()
    assert within_run and all(parts is not None and set(parts) <= {2004} for parts in within_run) and monkeypatch_done is None
    files = second.observations.inputFiles()
    assert {f.split("year=")[1].split("/")[0] for f in files} == {"2001", "2002", "2003", "2004"}
    after = tree(base, "observations")
    assert {k: after[k] for k in before} == before
    assert all("year=2004" in k for k in set(after) - set(before))
    assert is_full(second, day) and second.changed_stations.count() == 0
    kept = {q.path for q in second.held} & {q.path for q in first.held}
    assert {q.path for q in first.held if q.table == "closed"} <= kept
    wanted = ladder.new_record_events(second.record_events, first.record_events)
    assert wanted.count() > 0 and second.record_events_new.exceptAll(wanted).count() == wanted.exceptAll(second.record_events_new).count() == 0

    # 2. a run that fails before it publishes is never seen
    def fail():
        raise OSError("lost")

    fix = log(spark, [date(2002, 7, 7)], 2, stations=[2], shift=500.0)
    with pytest.raises(OSError):
        incremental.run_cycle(spark, base, fix, p(day), buckets=4, before_publish=fail)
    assert versions.current(base) == second.version
    held = versions.pieces(spark, base, versions.current(base))
    assert incremental.observations_of(spark, base, held).agg(F.max("tmax")).first()[0] < 200

    # 3. a correction of a settled day: its station's bucket is written anew, the others stay; provisional days confirmed
    third = incremental.run_cycle(spark, base, fix.unionByName(log(spark, new_days[-3:], 2)), p(day + timedelta(1)), buckets=4)
    assert [r[0] for r in third.changed_stations.collect()] == ["s2"] and is_full(third, day)
    bucket = spark.createDataFrame([("s2",)], "station_id string").select(incremental._bucket(4)).first()[0]
    gone = {q.part for q in second.held if q.table == "closed"} & {q.part for q in second.held if q.table == "closed" and q not in third.held}
    assert gone == {bucket}
    assert third.observations.agg(F.max("tmax")).first()[0] >= 500
    wanted = ladder.new_record_events(third.record_events, second.record_events)
    assert third.record_events_new.exceptAll(wanted).count() == wanted.exceptAll(third.record_events_new).count() == 0

    one = incremental.station_ladder(spark, base, third.held, "s2", 4)
    wanted = third.record_events.filter("station_id = 's2'").orderBy(*ladder.display_order()).collect()
    assert one.collect() == wanted and len(wanted) > 20
    text = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in text and "EqualTo(station_id,s2)" in text

    # 4. the same version cannot be followed twice, and settled days do not come back
    other = lambda: versions.replace_small(base, versions.POINTER, second.version)
    with pytest.raises(versions.Conflict):
        incremental.run_cycle(spark, base, log(spark, [day], 3), p(day + timedelta(2)), buckets=4, before_publish=other)
    versions.replace_small(base, versions.POINTER, third.version)
    with pytest.raises(ValueError):
        incremental.run_cycle(spark, base, log(spark, [day], 3), p(day), buckets=4)


def test_pieces_are_merged(spark, tmp_path, monkeypatch):
    """A bucket whose pieces reach the limit is one piece again; a year that is purged to nothing leaves the manifest."""
    monkeypatch.setattr(versions, "MOST_PIECES", 2)
    base, cycle = str(tmp_path), None
    for k, year in enumerate((2001, 2002, 2003, 2004)):
        days = naive.day_range(date(year, 1, 1), 60)
        cycle = incremental.run_cycle(spark, base, log(spark, days, k, stations=[1], provisional=year == 2004), p(date(year, 12, 1) if year < 2004 else days[-1]), buckets=1)
        assert sum(q.table == "closed" for q in cycle.held) <= 2
        assert is_full(cycle, days[-1])
    assert {q.part for q in cycle.held if q.table == "observations"} == {2001, 2002, 2003, 2004}
    cycle = incremental.run_cycle(spark, base, log(spark, [date(2003, 2, 20)], 9, stations=[1]), p(date(2004, 12, 1)), buckets=1)
    assert {q.part for q in cycle.held if q.table == "observations"} == {2001, 2002, 2003}
    assert is_full(cycle, date(2004, 12, 1))
