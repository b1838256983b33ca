"""The daily cycle's table: every stored row and arrival is resolved, then stale provisionals go."""

from datetime import date, timedelta

from pyspark.sql import functions as F

from highmark.operators import resolve
from highmark.params import RunParams
from highmark.plans import daily
from highmark.schemas import OBSERVATIONS

P = RunParams(as_of=date(2020, 2, 1))
NEW, STALE, QUIET = P.as_of - timedelta(1), P.as_of - timedelta(16), P.as_of - timedelta(40)
LOG = "station_id string, obs_date date, tmax double, tmin double, provisional boolean, seq long"


def cycle(observations):
    return daily.CycleInputs(aliases=None, names=None, observations=observations)


def table(spark, stored, arrived=None):
    obs = None if stored is None else spark.createDataFrame(stored, LOG.removesuffix(", seq long"))
    log = None
    if arrived is not None:
        log = spark.createDataFrame(arrived, LOG)
        log = resolve.as_observations(log).withColumn("seq", F.lit(0).cast("bigint"))
    got = daily.current_observations(cycle(obs), log, P)
    assert got.columns == OBSERVATIONS.names
    return sorted((r.station_id, r.obs_date, r.tmax, r.tmin, r.provisional) for r in got.collect())


def test_days_without_arrivals_are_resolved_too(spark):
    stored = [("a", QUIET, 1.0, 1.0, False), ("a", QUIET, 9.0, 0.0, True), ("b", QUIET, 2.0, 2.0, None), ("c", NEW, 3.0, None, True), ("c", NEW, 4.0, 1.0, True)]
    want = [("a", QUIET, 1.0, 1.0, False), ("b", QUIET, 2.0, 2.0, False), ("c", NEW, 4.0, 1.0, True)]
    assert table(spark, stored) == want
    assert table(spark, stored, [("d", STALE, 5.0, 5.0, False, 0)]) == [*want, ("d", STALE, 5.0, 5.0, False)]


def test_the_purge_follows_the_arrivals(spark):
    """a: confirmed too late; b: stale when it arrives; c: stale on both sides; d: still young."""
    stored = [("a", STALE, 9.0, 9.0, True), ("c", STALE, 1.0, 1.0, True), ("d", NEW, 1.0, 1.0, True)]
    arrived = [("a", STALE, 5.0, 5.0, False, 0), ("b", STALE, 2.0, 2.0, True, 0), ("c", STALE, 2.0, 2.0, True, 0), ("d", NEW, 0.0, 0.0, True, 0)]
    want = [("a", STALE, 5.0, 5.0, False), ("d", NEW, 1.0, 0.0, True)]
    assert table(spark, stored, arrived) == want
    assert table(spark, None, arrived) == [want[0], ("d", NEW, 0.0, 0.0, True)]
