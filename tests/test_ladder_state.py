"""The ladder from its state: any cut of a series into steps gives the ladder of the whole."""

from datetime import date

import pytest
from pyspark.sql import functions as F

import naive
import test_ladder
from highmark.operators import ladder_state
from highmark.params import RunParams
from highmark.schemas import EVENT_COLUMNS

P = test_ladder.P
QUICK = RunParams(as_of=P.as_of, gap_reset_days=5, warmup_days=20)


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*EVENT_COLUMNS).collect()), key=repr)


def kept(df, path):
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def check_steps(spark, tmp_path, rows, cuts, p):
    """Settle up to the first cut, advance to each further one, extend by the rest; the ladder holds after every step."""
    obs = spark.createDataFrame(rows, test_ladder.SCHEMA)
    before = obs.filter(F.col("obs_date") <= cuts[0])
    rungs = kept(ladder_state.whole(before, p), f"{tmp_path}/r")
    closed, state = ladder_state.closed_rungs(rungs), ladder_state.state_of(rungs)
    assert state.columns == ["station_id", "last_day", "seg_start", "tops"]
    for k, (low, high) in enumerate(zip(cuts, [*cuts[1:], date.max])):
        step = obs.filter((F.col("obs_date") > low) & (F.col("obs_date") <= high))
        rungs = kept(ladder_state.walk(state, step, p), f"{tmp_path}/r{k}")
        full = rows_of(closed.unionByName(ladder_state.added_events(rungs)))
        assert full == naive.ladder([r for r in rows if r[1] <= high], p.warmup_days, p.gap_reset_days)
        closed, state = closed.unionByName(ladder_state.closed_rungs(rungs)), ladder_state.state_of(rungs)
    fresh = ladder_state.state_of(ladder_state.whole(obs, p))
    assert sorted(map(repr, state.collect())) == sorted(map(repr, fresh.collect()))
    assert max(len(r["tops"]) for r in state.collect()) <= 26


@pytest.mark.parametrize("seed,p", [(1, P), (3, QUICK)])
def test_steps(spark, tmp_path, seed, p):
    rows = test_ladder.random_rows(seed)
    cuts = [date(2006, 2, 11), date(2006, 3, 1), date(2011, 12, 31)]
    check_steps(spark, tmp_path, rows, cuts, p)


def test_daily_steps_through_warm_up_and_gap(spark, tmp_path):
    """Open rungs are replaced over a cut, closed ones are not, and a gap over a cut opens a segment."""
    days = naive.day_range(date(2010, 1, 1), 6) + naive.day_range(date(2010, 1, 20), 30)
    rows = [("a", d, float(i), float(-i), None) for i, d in enumerate(days)] + [("b", days[10], 1.0, None, False)]
    check_steps(spark, tmp_path, rows, [days[2], days[6], days[20]], QUICK)


def test_station_before_and_after_the_state(spark):
    """No state at all, a station without new days, and days without a temperature."""
    rows = [("a", date(2010, 1, 1), 1.0, 2.0, False)]
    obs = spark.createDataFrame(rows, test_ladder.SCHEMA)
    none = spark.createDataFrame([], ladder_state.STATE)
    assert rows_of(ladder_state.added_events(ladder_state.walk(none, obs, P))) == naive.ladder(rows)
    rungs = ladder_state.whole(obs, P)
    assert ladder_state.closed_rungs(rungs).count() == 0  # all are open still
    blank = spark.createDataFrame([("a", date(2010, 1, 2), None, None, False)], test_ladder.SCHEMA)
    later = ladder_state.walk(ladder_state.state_of(rungs), blank, P)
    assert rows_of(ladder_state.added_events(later)) == naive.ladder(rows)
    assert ladder_state.closed_rungs(later).count() == 0
    assert list(map(repr, ladder_state.state_of(later).collect())) == list(map(repr, ladder_state.state_of(rungs).collect()))
