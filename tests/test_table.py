"""The keyed table: resolving, merging, purging, stored forms."""

import itertools
import re
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from highmark.operators import resolve, stats
from highmark.params import RunParams
from highmark.schemas import OBSERVATIONS
from highmark.sources import tables

D = date(2020, 1, 1)
P = RunParams(as_of=date(2020, 2, 1))
LOG = "station_id string, obs_date date, tmax double, tmin double, provisional boolean, seq long"


def _log(spark, rows):
    df = spark.createDataFrame(rows, LOG)
    missing = [f for f in OBSERVATIONS if f.name not in df.columns]
    return df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing])


def resolved(spark, rows):
    return {(r.station_id, r.obs_date): (r.tmax, r.tmin, r.provisional) for r in resolve.resolve_observations(_log(spark, rows)).collect()}


def test_definitive_wins_even_without_values(spark):
    rows = [("a", D, None, None, False, 1), ("a", D, 40.0, 1.0, True, 2), ("b", D, 1.0, 1.0, None, 1), ("b", D, 9.0, 9.0, True, 3)]
    assert resolved(spark, rows) == {("a", D): (None, None, False), ("b", D): (1.0, 1.0, False)}


def test_latest_definitive_and_merged_provisional(spark):
    rows = [("a", D, 5.0, 1.0, False, 2), ("a", D, 9.0, 9.0, False, 1), ("b", D, 5.0, None, True, 1), ("b", D, 4.0, 2.0, True, 2), ("b", D, None, 3.0, True, 3)]
    assert resolved(spark, rows) == {("a", D): (5.0, 1.0, False), ("b", D): (5.0, 2.0, True)}


def test_independent_of_arrival_order_and_idempotent(spark):
    rows = [("a", D, 5.0, 1.0, True, 1), ("a", D, 7.0, 0.0, True, 2), ("c", D, 1.0, 1.0, False, 5), ("c", D, 2.0, 2.0, False, 5)]
    results = [resolved(spark, list(p)) for p in itertools.islice(itertools.permutations(rows), 0, 24, 7)]
    assert all(r == results[0] for r in results)
    again = [(s, d, *v, 0) for (s, d), v in results[0].items()]
    assert resolved(spark, again) == results[0]


def test_many_copies_of_one_key(spark):
    rows = spark.range(200_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 1000)).alias("station_id"),
        F.lit(D).alias("obs_date"), F.col("id").cast("double").alias("tmax"), (-F.col("id")).cast("double").alias("tmin"),
        F.lit(True).alias("provisional"), F.col("id").alias("seq"),
    )
    missing = [f for f in OBSERVATIONS if f.name not in rows.columns]
    result = resolve.resolve_observations(rows.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing]))
    hot = result.filter("station_id = 'hot'").collect()
    assert [(r.tmax, r.tmin) for r in hot] == [(199998.0, -199998.0)]


OBS = "station_id string, obs_date date, tmax double, tmin double, prec double, provisional boolean"


def test_merge_provisional(spark):
    current = spark.createDataFrame(
        [("def", D, 1.0, 1.0, 7.0, False), ("null", D, 1.0, 1.0, 7.0, None), ("prov", D, 5.0, None, 7.0, True), ("alone", D, 2.0, 2.0, None, True)], OBS
    )
    incoming = spark.createDataFrame(
        [("def", D, 9.0, -9.0), ("null", D, 9.0, -9.0), ("prov", D, 4.0, 3.0), ("prov", D, 6.0, 4.0), ("new", D, None, 8.0)],
        "station_id string, obs_date date, tmax double, tmin double",
    )
    got = {r.station_id: (r.tmax, r.tmin, r.prec, r.provisional) for r in resolve.merge_provisional(current, incoming).collect()}
    assert got == {
        "def": (1.0, 1.0, 7.0, False), "null": (1.0, 1.0, 7.0, False), "prov": (6.0, 3.0, 7.0, True),
        "alone": (2.0, 2.0, None, True), "new": (None, 8.0, None, True),
    }
    # The count of written keys alone takes an unset flag as not definitive.
    assert resolve.provisional_written(current, incoming).first()[0] == 3


def test_apply_arrivals_equals_resolving_everything(spark):
    other = D + timedelta(1)
    stored = [("a", D, 1.0, 1.0, False), ("a", other, 2.0, 2.0, None), ("b", D, 3.0, 3.0, True), ("c", other, 4.0, 4.0, True)]
    new = [("a", D, 9.0, 0.0, True, 0), ("b", D, 5.0, 5.0, True, 0), ("b", D, 8.0, 8.0, False, 1), ("d", D, 1.0, 1.0, True, 1)]
    table = spark.createDataFrame(stored, "station_id string, obs_date date, tmax double, tmin double, provisional boolean")
    got = resolve.apply_arrivals(table, _log(spark, new)).collect()
    assert {(r.station_id, r.obs_date): (r.tmax, r.tmin, r.provisional) for r in got} == resolved(spark, [(*r, -1) for r in stored] + new)


def test_purge(spark):
    days = [P.as_of - timedelta(n) for n in (14, 15, 16)]
    rows = [("a", d, 1.0, 1.0, None, flag) for d in days for flag in (True,)] + [("b", days[2], 1.0, 1.0, None, f) for f in (None,)]
    df = spark.createDataFrame(rows, OBS)
    assert sorted(resolve.purge_provisional(df, P).select("station_id", "obs_date").collect()) == sorted([("a", days[0]), ("a", days[1]), ("b", days[2])])
    assert resolve.purged_count(df, P).first()[0] == 1


def test_resolve_stations(spark):
    schema = "station_id string, name string, province string, altitude int, lat double, lon double, synop_id string, seq long"
    df = spark.createDataFrame([("a", "old", "P", 1, 1.0, 1.0, None, 1), ("a", "new", None, None, None, None, None, 2)], schema)
    assert [(r.name, r.province) for r in resolve.resolve_stations(df).collect()] == [("new", None)]


def test_missing_column_gets_default_but_values_stay(spark):
    bare = spark.createDataFrame([("a", D)], "station_id string, obs_date date")
    assert resolve.as_observations(bare).first().provisional is False
    flagged = spark.createDataFrame([("a", D, True), ("b", D, None)], "station_id string, obs_date date, provisional boolean")
    assert {r.station_id: r.provisional for r in resolve.as_observations(flagged).collect()} == {"a": True, "b": None}


def test_snapshot_and_restore(spark, tmp_path):
    obs = resolve.as_observations(spark.createDataFrame([("a", D, 1.0, 2.0, None, True)], OBS))
    folder = str(tmp_path / "snap")
    tables.snapshot({"observations": obs}, folder)
    back = tables.restore(spark, folder)
    assert back["observations"].collect() == obs.collect()
    assert back["stations"].isEmpty() and back["month_ledger"].columns == ["year", "month", "n_rows", "seq"]
    with pytest.raises(Exception, match="already exists"):
        tables.snapshot({"observations": obs}, folder)
    target = str(tmp_path / "store")
    tables.restore_into(spark, folder, target)
    with pytest.raises(Exception, match="already exists"):
        tables.restore_into(spark, folder, target)
    with pytest.raises(ValueError):
        tables.snapshot({"record_events": obs}, folder)


def test_observation_files_are_pruned_by_year(spark, tmp_path):
    rows = [(f"s{i % 7}", date(2000 + i % 5, 1, 1) + timedelta(i), float(i), None, None, False) for i in range(300)]
    obs = resolve.as_observations(spark.createDataFrame(rows, OBS))
    tables.write_observations(obs, str(tmp_path / "obs"), files_per_year=3)
    back = tables.read_observations(spark, str(tmp_path / "obs"))
    assert sorted(back.drop("year").collect(), key=repr) == sorted(obs.collect(), key=repr)
    assert len(list((tmp_path / "obs" / "year=2002").glob("*.parquet"))) <= 3


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_year_bounds_and_arrivals_prune_partitions(spark, tmp_path):
    rows = [(f"s{i % 7}", date(2000 + i % 5, 1, 1) + timedelta(i), float(i), None, None, False) for i in range(300)]
    obs = resolve.as_observations(spark.createDataFrame(rows, OBS))
    tables.write_observations(obs, str(tmp_path / "obs"))
    back = tables.read_observations(spark, str(tmp_path / "obs"))
    groups = spark.createDataFrame([(f"s{i}", "g") for i in range(7)], "station_id string, group_id string")
    params = RunParams(as_of=date(2006, 1, 1), min_year=2003)
    cells = stats.stations_by_period_group(back, groups, params, False)
    assert "PartitionFilters: [isnotnull(year" in plan_of(cells)
    assert sorted(cells.collect(), key=repr) == sorted(stats.stations_by_period_group(obs, groups, params, False).collect(), key=repr)
    arriving = obs.filter("obs_date < '2000-02-01'").withColumn("seq", F.lit(1).cast("bigint"))
    touched, _ = resolve._split_by_day(back, arriving)
    assert "dynamicpruning" in plan_of(touched).lower()
    got, want = resolve.apply_arrivals(back, arriving), resolve.apply_arrivals(obs, arriving)
    assert sorted(got.collect(), key=repr) == sorted(want.collect(), key=repr)


def test_station_map_versions(spark, tmp_path):
    path = str(tmp_path / "map")
    assert tables.load_station_map(spark, path).isEmpty()
    tables.save_station_map(spark.createDataFrame([("X", "P", "1")], "name string, province string, station_id string"), path)
    assert [tuple(r) for r in tables.load_station_map(spark, path).collect()] == [("X", "P", "1")]


def test_arrival_counts(spark):
    df = spark.createDataFrame([("a", D, 1.0, 1.0), ("a", D, 2.0, 1.0), ("b", D, 1.0, 1.0)], "station_id string, obs_date date, tmax double, tmin double")
    assert tuple(resolve.arrival_counts(df).first()) == (2, 1, 2)


def test_resolving_sorts_by_a_number_and_reads_days_once(spark, sf_dir):
    """Rows are told apart by a number before ids and days; null keys and days before 1970 resolve as all others."""
    import contextlib
    import io

    import standins

    log = [
        (None, None, True, 1, 3.0), (None, None, True, 2, 5.0), ("a", None, False, 1, 1.0), ("a", None, False, 2, 2.0),
        ("a", date(1931, 5, 2), False, 4, 7.0), ("a", date(1931, 5, 2), True, 9, 8.0), (None, date(1931, 5, 2), True, 1, 6.0),
    ]
    rows = resolve.conform(
        spark.createDataFrame(log, "station_id string, obs_date date, provisional boolean, seq long, tmax double"),
        StructType([*OBSERVATIONS.fields, StructField("seq", LongType())]),
    )
    found = {(r["station_id"], r["obs_date"], r["tmax"], r["provisional"]) for r in resolve.resolve_observations(rows).collect()}
    assert found == {
        (None, None, 5.0, True), ("a", None, 2.0, False), ("a", date(1931, 5, 2), 7.0, False), (None, date(1931, 5, 2), 6.0, True)
    }
    with contextlib.redirect_stdout(io.StringIO()) as text:
        resolve.resolve_observations(standins.ingest_log(spark, sf_dir)).explain("simple")
    plan = text.getvalue()
    assert plan.count("FileScan") == 1
    assert re.search(r"Sort \[\w+#\d+L ASC", plan)
