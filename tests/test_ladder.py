import random
import re
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

import naive
import standins
from catalog import queries
from highmark.operators import ladder
from highmark.params import RunParams
from highmark.schemas import EVENT_COLUMNS
from highmark.session import SETTINGS

P = RunParams(as_of=date(2020, 12, 31))
SCHEMA = "station_id string, obs_date date, tmax double, tmin double, provisional boolean"


def events(spark, rows, p=P):
    result = ladder.record_events(spark.createDataFrame(rows, SCHEMA), p)
    return sorted((tuple(r) for r in result.select(*EVENT_COLUMNS).collect()), key=repr)


def random_rows(seed, stations=6, years=12):
    rng = random.Random(seed)
    rows = []
    for s in range(stations):
        day = date(2003, 1, 1) + timedelta(days=rng.randrange(400))
        while day.year < 2003 + years:
            value = lambda: None if rng.random() < 0.2 else float(rng.randrange(40) + day.month)
            rows.append((f"s{s}", day, value(), value(), rng.choice([True, False, None])))
            day += timedelta(days=rng.choice([1, 1, 1, 2, 5, 20, 29, 179, 180, 181] if rng.random() < 0.2 else [1, 2]))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize(
    "p",
    [P, RunParams(as_of=P.as_of, block_years=1), RunParams(as_of=P.as_of, gap_reset_days=5, warmup_days=20)],
)
def test_equals_day_by_day_walk(spark, seed, p):
    rows = random_rows(seed)
    assert events(spark, rows, p) == naive.ladder(rows, p.warmup_days, p.gap_reset_days)


def test_one_station_holding_most_rows(spark):
    rows = random_rows(7, stations=1, years=15) + random_rows(8, stations=9, years=1)
    rows = [("hot" if i < 3000 else s, *rest) for i, (s, *rest) in enumerate(rows)]
    rows = list({(r[0], r[1]): r for r in rows}.values())
    assert events(spark, rows) == naive.ladder(rows)


def test_pruning_keeps_few_days_of_a_dense_series(spark):
    rows = [
        ("a", d, float((i * 7919) % 101), float((i * 104729) % 97), False)
        for i, d in enumerate(naive.day_range(date(1990, 1, 1), 7300))
    ]
    kept = ladder._ladder_days(spark.createDataFrame(rows, SCHEMA), P).count()
    assert kept < 0.2 * len(rows)
    assert events(spark, rows) == naive.ladder(rows)


def test_ties_do_not_count_and_min_kinds_look_for_the_highest(spark):
    d = date(2010, 5, 1)
    rows = [("a", d, 10.0, 3.0, False), ("a", d + timedelta(400), 10.0, 2.0, False), ("a", d + timedelta(401), 10.5, 3.5, False)]
    rows = [rows[0]] + [("a", x, None, -9.0, False) for x in naive.day_range(d + timedelta(1), 399)] + rows[1:]
    got = {(e[1], e[2]): e for e in events(spark, rows)}
    assert ("all_max", d + timedelta(400)) not in got
    assert got[("all_max", d + timedelta(401))][4:6] == (10.5, 10.0)
    assert got[("all_min", d + timedelta(401))][4:6] == (3.5, 3.0)


@pytest.mark.parametrize("gap,beaten", [(179, True), (180, False)])
def test_gap_of_180_days_restarts_maturity(spark, gap, beaten):
    first = naive.day_range(date(2010, 1, 1), 400)
    rows = [("a", d, 1.0, None, False) for d in first] + [("a", first[-1] + timedelta(gap), 2.0, None, False)]
    last = [e for e in events(spark, rows) if e[1] == "all_max"][-1]
    assert (last[5] is not None) == beaten


@pytest.mark.parametrize("age,beaten", [(364, False), (365, True)])
def test_warm_up_lasts_365_days(spark, age, beaten):
    start = date(2011, 1, 1)
    rows = [("a", d, 1.0, None, False) for d in naive.day_range(start, age)] + [("a", start + timedelta(age), 2.0, None, False)]
    got = [e for e in events(spark, rows) if e[1] == "all_max"]
    assert len(got) == (2 if beaten else 1)
    assert (got[-1][5] == 1.0) == beaten


def test_first_monthly_value_after_maturity_is_initial(spark):
    start = date(2010, 1, 1)
    rows = [("a", d, 5.0, None, False) for d in naive.day_range(start, 31)]
    rows += [("a", d, 5.0, None, False) for d in naive.day_range(date(2010, 6, 1), 280)]
    rows += [("a", date(2011, 4, 1), 1.0, None, True)]
    april = [e for e in events(spark, rows) if e[3] == 4]
    assert [(e[1], e[5], e[6]) for e in april] == [("month_max", None, True)]


def test_segments_match_events_input(spark):
    rows = random_rows(3)
    obs = spark.createDataFrame(rows, SCHEMA)
    seg = {(r.station_id, r.obs_date): r for r in ladder.coverage_segments(obs, P).collect()}
    assert len(seg) == sum(1 for r in rows if r[2] is not None or r[3] is not None)
    for event in events(spark, rows):
        if event[5] is not None:
            assert seg[(event[0], event[2])].mature


def test_new_events_key_and_first_run(spark):
    old = spark.createDataFrame(
        [("a", "all_max", date(2015, 1, 1), None, 5.0, 4.0, True, 9), ("a", "month_max", date(2015, 1, 1), 1, 5.0, 4.0, False, 9)],
        "station_id string, kind string, obs_date date, month int, value double, prev_value double, provisional boolean, days_since_prev int",
    )
    now = old.withColumn("provisional", F.lit(False))
    fresh = ladder.new_record_events(now, old).collect()
    assert [(r.kind, r.provisional) for r in fresh] == [("all_max", False)]
    assert ladder.new_record_events(now).count() == 0


def test_properties(spark, sf_dir):
    obs = standins.observations(spark, sf_dir, "part")
    got = sorted((tuple(r) for r in ladder.record_events(obs, standins.PART).collect()), key=lambda e: (e[0], e[1], e[3] or 0, e[2]))
    last = {}
    for station, kind, day, month, value, *_ in got:
        key = (station, kind, month)
        if key in last:
            assert value > last[key]
        last[key] = value
    top = {r.station_id: r.top for r in obs.groupBy("station_id").agg(F.max("tmax").alias("top")).collect()}
    for (station, kind, _), value in last.items():
        if kind == "all_max":
            assert value == top[station]


# Measured once with an independent query on days up to 2001-06-30.
EXPECTED = {
    "supplier": {"all_max": (18, 8, 3509), "all_min": (19, 9, 5719), "month_max": (328, 208, 118796), "month_min": (330, 210, 120210)},
    "part": {"all_max": (496, 98, 197212), "all_min": (486, 100, 190337), "month_max": (2581, 263, 549613), "month_min": (2126, 166, 379998)},
}


@pytest.mark.parametrize("role", ["supplier", "part"])
def test_known_figures(spark, role):
    obs = standins.observations(spark, "/root/testdata/sf0.001", role).filter("obs_date <= '2001-06-30'")
    rows = ladder.record_events(obs, standins.PART).groupBy("kind").agg(F.count("*"), F.count("prev_value"), F.sum("days_since_prev")).collect()
    assert {r[0]: tuple(r)[1:] for r in rows} == EXPECTED[role]


def test_days_are_not_sorted_again_for_segments(spark):
    """Starts follow from the order of days that the other windows use, null days and gaps included."""
    days = [None, "2000-01-01", "2000-01-02", "2003-01-01", "2003-01-01", "2003-01-05"]
    obs = spark.createDataFrame([("a", d, 1.0, None, False) for d in days], "station_id string, obs_date string, tmax double, tmin double, provisional boolean")
    obs = obs.withColumn("obs_date", F.col("obs_date").cast("date"))
    told = ladder.coverage_segments(obs, RunParams(as_of=date(2010, 1, 1)))
    assert sorted((str(r.obs_date), r.seg_id, str(r.seg_start)) for r in told.collect()) == [
        ("2000-01-01", 0, "2000-01-01"), ("2000-01-02", 0, "2000-01-01"), ("2003-01-01", 1, "2003-01-01"),
        ("2003-01-01", 1, "2003-01-01"), ("2003-01-05", 1, "2003-01-01"), ("None", 0, "2000-01-01"),
    ]
    plan = told._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search(r"windowspecdefinition\(station_id#[0-9]+, seg_id", plan)


def test_jobs_settle_the_size_of_tasks(spark, sf_dir):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m")
    queries()["record_events"](spark, sf_dir)
    assert all(spark.conf.get(k) == v for k, v in SETTINGS.items())
