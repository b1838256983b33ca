"""A cycle that writes only what arrivals change: years of the table, and the ladder from its state.

Days up to ``as_of - provisional_max_age_days - 1`` are settled: after the purge all of them are
definitive. The store (``sources/versions.py``) holds

* ``observations`` by year; a run writes the years of its arrivals and of what it purges,
* ``closed``, the rungs that no later day changes, by station bucket, each file in the order in which
  ladders are published; runs append to it,
* ``state``, one row per station as of the settled day,
* ``tail``, the events that rest on days after the settled one.

The ladder is ``closed`` and ``tail``. A run reads the years from the settled day on. Only where an
arrival changes a settled day are whole series read again, those of its stations; what their buckets
hold is then written anew.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from highmark.functions.predicates import is_provisional
from highmark.operators import ladder, ladder_state, resolve
from highmark.params import RunParams
from highmark.schemas import OBSERVATIONS
from highmark.sources import versions
from highmark.sources.tables import write_observations
from highmark.sources.versions import Piece

BUCKETS = 32
_DATED = T.StructType([*OBSERVATIONS.fields, T.StructField("year", T.IntegerType())])
_BUCKETED = f"{ladder_state.EVENTS}, bucket int"


@dataclass
class Cycle:
    """What a run leaves: its version, the table and the ladder through the manifest, and what is new."""

    base: str
    version: str
    held: list[Piece]
    observations: DataFrame
    record_events: DataFrame
    record_events_new: DataFrame
    changed_stations: DataFrame


def settled_day(p: RunParams) -> date:
    return p.as_of - timedelta(days=p.provisional_max_age_days + 1)


def observations_of(spark: SparkSession, base: str, held: list[Piece], from_year: int | None = None) -> DataFrame:
    """The table of a version, or its years from one on; other years' folders are not opened."""
    parts = None if from_year is None else {p.part for p in held if p.table == "observations" and p.part >= from_year}
    return versions.read_pieces(spark, base, "observations", held, _DATED, parts)


def ladder_of(spark: SparkSession, base: str, held: list[Piece]) -> DataFrame:
    """The ladder of a version."""
    closed = versions.read_pieces(spark, base, "closed", held, _BUCKETED).drop("bucket")
    return closed.unionByName(versions.read_pieces(spark, base, "tail", held, ladder_state.EVENTS))


def station_ladder(spark: SparkSession, base: str, held: list[Piece], station_id: str, buckets: int = BUCKETS) -> DataFrame:
    """One station's ladder in the order of publication: one bucket is opened, and of its files what holds the station."""
    mine = F.col("station_id") == station_id
    bucket = F.pmod(F.xxhash64(F.lit(station_id)), F.lit(buckets)).cast("int")
    closed = versions.read_pieces(spark, base, "closed", held, _BUCKETED).filter((F.col("bucket") == bucket) & mine).drop("bucket")
    tail = versions.read_pieces(spark, base, "tail", held, ladder_state.EVENTS).filter(mine)
    return closed.unionByName(tail).orderBy(*ladder.display_order())


def _stored(spark: SparkSession, df: DataFrame, path: str, schema) -> DataFrame:
    df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path)


def _write_years(spark: SparkSession, base: str, version: str, held: list[Piece], log: DataFrame, p: RunParams) -> list[Piece]:
    """Pieces of the table after the arrivals; years without arrivals or stale rows stay as they are."""
    horizon = p.as_of - timedelta(days=p.provisional_max_age_days)
    ours = {q.part: q for q in held if q.table == "observations"}
    arrived = {r["year"] for r in log.select(F.year("obs_date").alias("year")).distinct().collect()}
    touched = arrived | {y for y, q in ours.items() if q.oldest_provisional and q.oldest_provisional < horizon}
    if not touched:
        return list(ours.values())
    stored = resolve.purge_provisional(versions.read_pieces(spark, base, "observations", held, _DATED, touched), p)
    path = f"observations/run={version}"
    write_observations(resolve.apply_arrivals(stored, log), f"{base}/{path}")
    oldest = F.min(F.when(is_provisional(), F.col("obs_date")))
    written = spark.read.schema(_DATED).parquet(f"{base}/{path}").groupBy("year").agg(oldest.alias("oldest"))
    fresh = [Piece("observations", r["year"], f"{path}/year={r['year']}", r["oldest"]) for r in written.collect()]
    return [q for y, q in ours.items() if y not in touched] + fresh


def _changed(before: DataFrame, after: DataFrame, log: DataFrame, settled: date) -> DataFrame:
    """Stations for which an arrival changed a temperature of a settled day."""
    keys = log.filter(F.col("obs_date") <= F.lit(settled)).select(*resolve.KEY).distinct()

    def values(table: DataFrame, name: str) -> DataFrame:
        return table.join(keys, resolve.KEY, "left_semi").select(*resolve.KEY, F.struct("tmax", "tmin").alias(name))

    both = values(before, "old").join(values(after, "new"), resolve.KEY, "full_outer")
    same = F.col("old.tmax").eqNullSafe(F.col("new.tmax")) & F.col("old.tmin").eqNullSafe(F.col("new.tmin"))
    return both.filter(~same).select("station_id").distinct()


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("station_id"), F.lit(buckets)).cast("int")


def run_cycle(
    spark: SparkSession, base: str, log: DataFrame, p: RunParams, buckets: int = BUCKETS, before_publish: Callable[[], None] = lambda: None
) -> Cycle:
    """Take a numbered log of arrivals (as ``daily.arrivals`` gives it) into the store at ``base``.

    ``before_publish`` runs when all is written and nothing is visible yet.
    """
    last, version = versions.current(base), versions.new_version()
    held = versions.pieces(spark, base, last)
    settled, known = settled_day(p), [q for q in held if q.table == "state"]
    was_settled = known[0].settled if known else None
    if was_settled is not None and settled < was_settled:
        raise ValueError(f"settled up to {was_settled} already")
    stale_out = resolve.purge_provisional(log, p)
    log = _stored(spark, stale_out, f"{base}/arrivals/run={version}", log.schema)
    years = _write_years(spark, base, version, held, log, p)

    empty = spark.createDataFrame([], "station_id string")
    changed, rewritten, old_closed = empty, set(), [q for q in held if q.table == "closed"]
    if was_settled is None:
        settled_obs = observations_of(spark, base, years).filter(F.col("obs_date") <= F.lit(settled))
        rungs = ladder_state.whole(settled_obs, p)
    else:
        old_state = versions.read_pieces(spark, base, "state", held, ladder_state.STATE)
        recent = observations_of(spark, base, years, was_settled.year)
        days = recent.filter((F.col("obs_date") > F.lit(was_settled)) & (F.col("obs_date") <= F.lit(settled)))
        if not log.filter(F.col("obs_date") <= F.lit(was_settled)).isEmpty():
            again = {r["y"] for r in log.filter(F.col("obs_date") <= F.lit(was_settled)).select(F.year("obs_date").alias("y")).distinct().collect()}
            old = versions.read_pieces(spark, base, "observations", held, _DATED, again)
            new = versions.read_pieces(spark, base, "observations", years, _DATED, again)
            changed = _stored(spark, _changed(old, new, log, was_settled), f"{base}/changed/run={version}", "station_id string")
        hit = {r["b"] for r in changed.select(_bucket(buckets).alias("b")).distinct().collect()}
        counts: dict[int, int] = {}
        for q in old_closed:
            counts[q.part] = counts.get(q.part, 0) + 1
        rewritten = hit | {b for b, n in counts.items() if n >= versions.MOST_PIECES}
        if hit:
            old_state, days = (d.join(changed, "station_id", "left_anti") for d in (old_state, days))
        rungs = ladder_state.walk(old_state, days, p)
        if hit:
            series = observations_of(spark, base, years).filter(F.col("obs_date") <= F.lit(settled))
            rungs = rungs.unionByName(ladder_state.whole(series.join(changed, "station_id", "left_semi"), p))
    rungs = _stored(spark, rungs, f"{base}/rungs/run={version}", ladder_state.RUNGS)
    state = _stored(spark, ladder_state.state_of(rungs), f"{base}/state/run={version}", ladder_state.STATE)
    added, path = ladder_state.closed_rungs(rungs), f"closed/run={version}"
    if rewritten:
        kept = versions.read_pieces(spark, base, "closed", held, _BUCKETED, rewritten).drop("bucket")
        added = added.unionByName(kept.join(changed, "station_id", "left_anti") if hit else kept)
    added = added.withColumn("bucket", _bucket(buckets)).repartition("bucket").sortWithinPartitions("bucket", *ladder.display_order())
    added.write.mode("errorifexists").option("compression", "zstd").partitionBy("bucket").parquet(f"{base}/{path}")
    closed_now = spark.read.schema(_BUCKETED).parquet(f"{base}/{path}")
    closed = [q for q in old_closed if q.part not in rewritten]
    closed += [Piece("closed", r["bucket"], f"{path}/bucket={r['bucket']}") for r in closed_now.select("bucket").distinct().collect()]
    after = observations_of(spark, base, years, settled.year).filter(F.col("obs_date") > F.lit(settled))
    tail = ladder_state.added_events(ladder_state.walk(state, after, p))
    tail = _stored(spark, tail, f"{base}/tail/run={version}", ladder_state.EVENTS)

    new_held = [*years, *closed, Piece("state", 0, f"state/run={version}", settled=settled), Piece("tail", 0, f"tail/run={version}")]
    before_publish()
    versions.publish(spark, base, version, new_held, last)
    now = closed_now.drop("bucket").unionByName(tail)
    previous = None
    if last is not None:
        previous = versions.read_pieces(spark, base, "tail", held, ladder_state.EVENTS).unionByName(
            versions.read_pieces(spark, base, "closed", held, _BUCKETED, rewritten).drop("bucket")
        )
    return Cycle(
        base, version, new_held, observations_of(spark, base, new_held), ladder_of(spark, base, new_held),
        ladder.new_record_events(now, previous), changed,
    )


def run_counts(events: DataFrame, new_events: DataFrame, coverage: DataFrame) -> DataFrame:
    """One row on a run: events, new ones, stations with data and active ones."""
    stations = coverage.agg(F.count(F.lit(1)).alias("stations_with_data"), F.count_if("is_active").alias("active_stations"))

    def rows(table: DataFrame) -> Column:
        return table.agg(F.count(F.lit(1)).alias("n")).scalar()

    return stations.select(rows(events).alias("events"), rows(new_events).alias("new_events"), "stations_with_data", "active_stations")
