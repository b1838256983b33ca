"""Leaderboards over the ladder: active stations and definitive records only.

Per-station choices are aggregations (combined before the shuffle), dimension joins meet
one row per station, and every list is a bounded top-N. Ties end on station, kind, month.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from highmark.functions.predicates import (
    family, is_all_time, is_beaten, is_definitive, is_monthly, margin,
)
from highmark.params import RunParams
from highmark.schemas import MONTH_MAX

STATION_HEADER = ["station_id", "name", "province", "altitude"]
# List sizes.
TOP_SIZE, RECENT_SIZE, LONGEST_SIZE, MARGIN_SIZE, ACTIVE_SIZE = 10, 25, 20, 15, 12


def active_stations(coverage: DataFrame, stations: DataFrame) -> DataFrame:
    """Header of the stations that are active and present in the dimension."""
    active = coverage.filter("is_active").select("station_id")
    return stations.select(*STATION_HEADER).join(active, "station_id", "left_semi")


def ranking_rows(events: DataFrame, p: RunParams) -> DataFrame:
    """The events that can be in any of the lists below, from one shuffle of the ladder by station.

    Every list of these rows is the list of the whole ladder: what is no station's best or latest, nor among
    its own first rows of a list, is not among the first of all. Of a station stay its best row per kind and
    month, the latest ones, ``RECENT_SIZE`` recent and ``MARGIN_SIZE`` wide ones, and the beaten ones of
    the last 12 months and of its own last year, which is the year of the newest event or does not count.
    """
    station = Window.partitionBy("station_id")

    def place(window: Window, first: Column, *order: Column | str) -> Column:
        """Position among the rows for which ``first`` is true; these come before all others."""
        return F.when(first, F.row_number().over(window.orderBy(F.desc(first), *order)))

    sure, beaten = is_definitive(), is_definitive() & is_beaten()
    kind = Window.partitionBy("station_id", "kind", "month")
    newest = F.max("obs_date").over(station)
    recent = place(station, beaten, F.desc("obs_date"), F.desc(margin()), "kind", F.asc_nulls_first("month"))
    wide = place(station, beaten & is_all_time(), F.desc(margin()), F.desc("obs_date"), "kind")
    keep = (
        (place(station, F.lit(True), F.desc("obs_date")) == 1)
        | (place(kind, sure, F.desc("value"), "obs_date") == 1)
        | (place(kind, sure & is_all_time(), F.desc("obs_date"), F.desc("value")) == 1)
        | (recent <= RECENT_SIZE)
        | (wide <= MARGIN_SIZE)
        | (beaten & ((F.year("obs_date") == F.year(newest)) | (F.col("obs_date") >= F.add_months(F.lit(p.as_of), -12))))
    )
    return events.withColumn("keep", F.coalesce(keep, F.lit(False))).filter("keep").drop("keep")


def _of_kind(events: DataFrame, kind: str) -> DataFrame:
    return events.filter((F.col("kind") == kind) & is_definitive())


def _highest_then_earliest() -> Column:
    """Struct aggregate: highest value, and among equals the earliest date."""
    best = F.max(F.struct("value", (-F.unix_date("obs_date")).alias("age")))
    return F.struct(
        best["value"].alias("value"), F.date_from_unix_date(-best["age"]).alias("obs_date")
    )


def current_alltime_dates(events: DataFrame) -> DataFrame:
    """Day of each station's current all-time record, per family."""
    return (
        events.filter(is_all_time() & is_definitive())
        .groupBy("station_id", family().alias("family"))
        .agg(F.max("obs_date").alias("obs_date"))
    )


def _flag_alltime(rows: DataFrame, events: DataFrame, only_if: Column) -> DataFrame:
    """Mark the rows that fall on the day of the station's current all-time record."""
    current = current_alltime_dates(events).withColumnRenamed("obs_date", "alltime_date")
    same_day = F.coalesce(F.col("alltime_date") == F.col("obs_date"), F.lit(False))
    return (
        rows.join(current, ["station_id", "family"], "left")
        .withColumn("is_alltime", only_if & same_day)
        .drop("alltime_date", "family")
    )


def top_alltime(
    events: DataFrame, coverage: DataFrame, stations: DataFrame, kind: str, n: int = TOP_SIZE
) -> DataFrame:
    """Stations with the highest all-time record of a kind."""
    best = (
        _of_kind(events, kind)
        .groupBy("station_id")
        .agg(_highest_then_earliest().alias("best"))
        .select("station_id", "best.*")
    )
    return (
        best.join(active_stations(coverage, stations), "station_id")
        .orderBy(F.desc("value"), "obs_date", "station_id")
        .limit(n)
        .select(*STATION_HEADER, "value", "obs_date")
    )


def top_by_month(
    events: DataFrame, coverage: DataFrame, stations: DataFrame, kind: str, n: int = TOP_SIZE
) -> DataFrame:
    """The same per calendar month, with the position and the all-time mark."""
    best = (
        _of_kind(events, kind)
        .groupBy("station_id", "month")
        .agg(_highest_then_earliest().alias("best"))
        .select("station_id", "month", "best.*")
    )
    place = Window.partitionBy("month").orderBy(F.desc("value"), "obs_date", "station_id")
    ranked = (
        best.join(active_stations(coverage, stations), "station_id")
        .withColumn("pos", F.row_number().over(place))
        .filter(F.col("pos") <= n)
        .withColumn("family", F.lit("max" if kind == MONTH_MAX else "min"))
    )
    return _flag_alltime(ranked, events, F.lit(True)).select(
        "month", "pos", *STATION_HEADER, "value", "obs_date", "is_alltime"
    )


def _beaten_of_active(events: DataFrame, coverage: DataFrame, stations: DataFrame) -> DataFrame:
    return events.filter(is_beaten() & is_definitive()).join(
        active_stations(coverage, stations), "station_id"
    )


def recent_records(
    events: DataFrame, coverage: DataFrame, stations: DataFrame, n: int = RECENT_SIZE
) -> DataFrame:
    """Latest beaten records; monthly ones carry the all-time mark."""
    latest = (
        _beaten_of_active(events, coverage, stations)
        .orderBy(
            F.desc("obs_date"), F.desc(margin()), "station_id", "kind", F.asc_nulls_first("month")
        )
        .limit(n)
        .withColumn("family", family())
    )
    return _flag_alltime(latest, events, is_monthly()).select(
        "station_id", "name", "province", "kind", "month", "value", "prev_value",
        "obs_date", "provisional", "is_alltime",
    )


def longest_standing(
    events: DataFrame, coverage: DataFrame, stations: DataFrame, kind: str, n: int = LONGEST_SIZE
) -> DataFrame:
    """Current all-time records that have stood longest."""
    current = (
        _of_kind(events, kind)
        .groupBy("station_id")
        .agg(F.max(F.struct("obs_date", "value")).alias("last"))
        .select("station_id", "last.*")
    )
    return (
        current.join(active_stations(coverage, stations), "station_id")
        .orderBy("obs_date", "station_id")
        .limit(n)
        .select(*STATION_HEADER, "value", "obs_date")
    )


def largest_margins(
    events: DataFrame, coverage: DataFrame, stations: DataFrame, n: int = MARGIN_SIZE
) -> DataFrame:
    """All-time records that beat the one before by most."""
    return (
        _beaten_of_active(events.filter(is_all_time()), coverage, stations)
        .withColumn("margin", margin())
        .orderBy(F.desc("margin"), F.desc("obs_date"), "station_id", "kind")
        .limit(n)
        .select(
            "station_id", "name", "province", "kind", "value", "prev_value", "margin", "obs_date"
        )
    )


def latest_event_year(events: DataFrame) -> DataFrame:
    """Year of the newest event, provisional ones included."""
    return events.agg(F.year(F.max("obs_date")).alias("year"))


def most_active(
    events: DataFrame,
    coverage: DataFrame,
    stations: DataFrame,
    p: RunParams,
    mode: str,
    n: int = ACTIVE_SIZE,
) -> DataFrame:
    """Stations with most beaten records, in the latest event's ``year`` or the last ``12m``."""
    if mode == "year":
        period = F.year("obs_date") == latest_event_year(events).scalar()
    elif mode == "12m":
        period = F.col("obs_date") >= F.add_months(F.lit(p.as_of), -12)
    else:
        raise ValueError(f"mode must be 'year' or '12m', not {mode!r}")
    counted = (
        events.filter(is_beaten() & is_definitive() & period)
        .groupBy("station_id")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        counted.join(active_stations(coverage, stations), "station_id")
        .orderBy(F.desc("n"), F.asc_nulls_last("name"), "station_id")
        .limit(n)
        .select("station_id", "name", "province", "n")
    )
