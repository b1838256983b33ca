"""One row per station and day out of definitive and provisional arrivals.

Arrivals are appended to an ingest log (observation columns, ``provisional``, ``seq``).
All merging is by aggregation on (station, day): partial results are combined before the
shuffle, so repeated copies of one key cost one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from highmark.functions.predicates import is_definitive, is_provisional
from highmark.params import RunParams
from highmark.schemas import MEASURE_COLUMNS, OBSERVATIONS, STATIONS

KEY = ["station_id", "obs_date"]


def conform(df: DataFrame, schema, defaults: dict[str, object] | None = None) -> DataFrame:
    """Bring ``df`` to the declared columns; a missing one is added with its default.

    Columns that are present keep their values, NULLs included.
    """
    defaults = defaults or {}
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(defaults.get(f.name)))
            .cast(f.dataType)
            .alias(f.name)
            for f in schema
        ]
    )


def as_observations(df: DataFrame, provisional: bool | None = None) -> DataFrame:
    """Declared observation columns, with the flag set when ``provisional`` is given."""
    if provisional is not None:
        df = df.withColumn("provisional", F.lit(provisional))
    return conform(df, OBSERVATIONS, {"provisional": False})


def _latest(columns: list[str], when: Column | None = None) -> Column:
    """Row with the highest ``seq``; equal ``seq`` falls back to a stable hash of the row."""
    order = [F.col("seq"), F.xxhash64(*columns).alias("tie")]
    row = F.struct(*order, F.struct(*columns).alias("row"))
    return F.max(row if when is None else F.when(when, row)).getField("row")


def _place() -> Column:
    """A number that nearly names the key: sorts tell rows apart by it and seldom compare ids and days."""
    day = F.pmod(F.unix_date(F.col("obs_date").cast("date")), F.lit(1 << 20)).cast("bigint")
    return F.shiftleft(F.xxhash64("station_id"), 20).bitwiseOR(day)


def resolve_observations(log: DataFrame) -> DataFrame:
    """Latest definitive row per key, whatever its values; else the merged provisional ones.

    Rows are not numbers, so Spark aggregates them by sorting; hence the place in front of the key.
    """
    merged = (
        log.groupBy(_place().alias("place"), *KEY)
        .agg(
            _latest(MEASURE_COLUMNS, is_definitive()).alias("definitive"),
            F.max(F.when(is_provisional(), F.col("tmax"))).alias("prov_max"),
            F.min(F.when(is_provisional(), F.col("tmin"))).alias("prov_min"),
        )
        .withColumn("provisional", F.col("definitive").isNull())
    )
    provisional_value = {"tmax": F.col("prov_max"), "tmin": F.col("prov_min")}
    measures = [
        F.when(F.col("provisional"), provisional_value.get(c, F.lit(None).cast(t)))
        .otherwise(F.col("definitive").getField(c))
        .alias(c)
        for c, t in ((c, OBSERVATIONS[c].dataType) for c in MEASURE_COLUMNS)
    ]
    return merged.select(*KEY, *measures, "provisional")


def _split_by_day(stored: DataFrame, arriving: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stored rows on days with arrivals, and all others, without shuffling either.

    The broadcast side is the distinct days, so the calendar bounds it. A stored table that has
    its ``year`` is read for the days' years only where rows on them are looked for.
    """
    keys = ["year", "obs_date"] if "year" in stored.columns else ["obs_date"]
    days = F.broadcast(arriving.select(F.year("obs_date").alias("year"), "obs_date").distinct().select(keys))
    return as_observations(stored.join(days, keys, "left_semi")), as_observations(stored.join(days, keys, "left_anti"))


def apply_arrivals(stored: DataFrame, arrivals: DataFrame) -> DataFrame:
    """The keyed table after an arrival log; only days on which something arrived are resolved."""
    touched, rest = _split_by_day(stored, arrivals)
    before_all = touched.withColumn("seq", F.lit(-1).cast("bigint"))
    resolved = resolve_observations(before_all.unionByName(arrivals))
    return resolved.unionByName(rest.withColumn("provisional", is_provisional()))


def resolve_stations(log: DataFrame) -> DataFrame:
    """Latest row per station id."""
    columns = [f.name for f in STATIONS if f.name != "station_id"]
    return (
        log.groupBy("station_id")
        .agg(_latest(columns).alias("row"))
        .select("station_id", "row.*")
    )


def _daily_extremes(incoming: DataFrame) -> DataFrame:
    return incoming.groupBy(*KEY).agg(
        F.max("tmax").alias("new_max"), F.min("tmin").alias("new_min")
    )


def merge_provisional(current: DataFrame, incoming: DataFrame) -> DataFrame:
    """Add provisional extremes to a keyed table without touching a definitive row."""
    touched, rest = _split_by_day(current, incoming)
    old = touched.withColumn("known", F.lit(True))
    both = old.join(_daily_extremes(incoming), KEY, "full_outer")
    keep = F.col("known").isNotNull() & is_definitive()
    measures = {c: F.col(c) for c in MEASURE_COLUMNS} | {
        "tmax": F.when(keep, F.col("tmax")).otherwise(F.greatest("tmax", "new_max")),
        "tmin": F.when(keep, F.col("tmin")).otherwise(F.least("tmin", "new_min")),
    }
    merged = both.select(
        *KEY,
        *[measures[c].alias(c) for c in MEASURE_COLUMNS],
        (~keep).alias("provisional"),
    )
    return merged.unionByName(rest.withColumn("provisional", is_provisional()))


def provisional_written(current: DataFrame, incoming: DataFrame) -> DataFrame:
    """How many incoming keys a merge writes: those without a row flagged definitive.

    Unlike every other reader, the count takes an unset flag as not definitive.
    """
    flagged = current.filter(~F.col("provisional")).select(*KEY)
    return (
        _daily_extremes(incoming)
        .join(flagged, KEY, "left_anti")
        .agg(F.count(F.lit(1)).alias("n_written"))
    )


def arrival_counts(incoming: DataFrame) -> DataFrame:
    """How many station days, days and stations an arrival of extremes covers."""
    days = _daily_extremes(incoming)
    return days.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("obs_date").alias("n_days"),
        F.count_distinct("station_id").alias("n_stations"),
    )


def _is_stale(p: RunParams) -> Column:
    horizon = F.date_sub(F.lit(p.as_of), p.provisional_max_age_days)
    return is_provisional() & (F.col("obs_date") < horizon)


def purge_provisional(current: DataFrame, p: RunParams) -> DataFrame:
    """Drop provisional rows that should have been confirmed by now.

    On a log, apply it before resolving, so that purged rows cannot come back.
    """
    return current.filter(~_is_stale(p))


def purged_count(current: DataFrame, p: RunParams) -> DataFrame:
    return current.agg(F.count_if(_is_stale(p)).alias("n_purged"))
