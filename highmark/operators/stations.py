"""Per-station read models: map summary, current records, timeline, and their join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from highmark.functions.predicates import family, is_all_time, is_beaten
from highmark.params import RunParams
from highmark.schemas import ALL_TIME_KINDS, EVENT_COLUMNS, KINDS, MONTHLY_KINDS

MONTHS = range(1, 13)
FAMILIES = ("max", "min")


def _last(columns: list[str], when: Column) -> Column:
    """Row with the latest date among those that satisfy ``when``."""
    return F.max(F.when(when, F.struct("obs_date", *columns)))


def station_summary(
    events: DataFrame, coverage: DataFrame, stations: DataFrame, p: RunParams
) -> DataFrame:
    """One row per active station: header, beaten totals, last beaten and recent count per kind.

    Provisional events count here.
    """
    per_station = events.filter(is_beaten()).groupBy("station_id").agg(*_totals(p))
    joined = _active(coverage, stations).join(per_station, "station_id", "left")
    return joined.select(*_summary_columns())


def _totals(p: RunParams) -> list[Column]:
    """Per kind, of beaten events: how many, how many recent ones, and the last one."""
    recent = F.col("obs_date") >= F.date_sub(F.lit(p.as_of), p.recent_days)
    aggs = []
    for kind in KINDS:
        of_kind = is_beaten() & (F.col("kind") == kind)
        aggs += [
            F.count_if(of_kind).alias(f"total_{kind}"),
            F.count_if(of_kind & recent).alias(f"recent15_{kind}"),
            _last(["value", "month", "provisional"], of_kind).alias(f"last_{kind}"),
        ]
    return aggs


def _active(coverage: DataFrame, stations: DataFrame) -> DataFrame:
    figures = coverage.filter("is_active").select("station_id", "first_date", "last_date", "n_days")
    return stations.join(figures, "station_id")


def _summary_columns() -> list[Column | str]:
    """Columns of ``station_summary`` out of the header and what ``_totals`` gives."""

    def count(name: str) -> Column:
        return F.coalesce(name, F.lit(0)).cast("bigint")

    def total(kinds: tuple[str, ...]) -> Column:
        return sum((count(f"total_{k}") for k in kinds), F.lit(0).cast("bigint"))

    return [
        "station_id", "name", "province", "altitude", "lat", "lon",
        "first_date", "last_date", "n_days",
        *[count(f"total_{k}").alias(f"total_{k}") for k in KINDS],
        *[count(f"recent15_{k}").alias(f"recent15_{k}") for k in KINDS],
        total(ALL_TIME_KINDS).alias("total_alltime"),
        total(MONTHLY_KINDS).alias("total_monthly"),
        *[
            F.col(f"last_{k}.{field}").alias(f"last_{k}_{name}")
            for k in KINDS
            for field, name in (
                ("obs_date", "date"), ("value", "value"),
                ("month", "month"), ("provisional", "provisional"),
            )
        ],
    ]


def current_alltime(events: DataFrame) -> DataFrame:
    """Latest all-time event per station and family, provisional ones included."""
    return (
        events.filter(is_all_time())
        .groupBy("station_id", family().alias("family"))
        .agg(_last(["value", "provisional"], F.lit(True)).alias("last"))
        .select("station_id", "family", "last.*")
    )


def current_monthly(events: DataFrame) -> DataFrame:
    """Twelve months by two families per station, NULL where the month has no record.

    A month's record on the day of the station's current all-time record of the same
    family is that record, and is marked.
    """
    newest = _last(["value", "provisional"], F.lit(True))
    per_key = (
        events.groupBy(
            "station_id", family().alias("family"), F.coalesce("month", F.lit(0)).alias("month")
        )
        .agg(newest.alias("last"))
        .withColumn("key", F.concat_ws("-", "family", "month"))
    )
    # At most 26 entries per station: 12 months and the all-time slot, in two families.
    per_station = per_key.groupBy("station_id").agg(
        F.map_from_entries(F.collect_list(F.struct("key", "last"))).alias("current"),
        F.bool_or(F.col("month") > 0).alias("has_month"),
    )
    slots = F.explode(
        F.array(*[F.struct(F.lit(m).alias("month"), F.lit(f).alias("family")) for m in MONTHS for f in FAMILIES])
    )
    record = F.try_element_at("current", F.concat_ws("-", "slot.family", "slot.month"))
    alltime = F.try_element_at("current", F.concat_ws("-", "slot.family", F.lit(0)))
    return (
        per_station.filter("has_month")
        .select("station_id", "current", slots.alias("slot"))
        .select(
            "station_id", "slot.month", "slot.family",
            record.alias("record"), alltime["obs_date"].alias("alltime_date"),
        )
        .select(
            "station_id", "month", "family",
            "record.obs_date", "record.value", "record.provisional",
            F.coalesce(F.col("record.obs_date") == F.col("alltime_date"), F.lit(False)).alias("is_alltime"),
        )
    )


def last_record(events: DataFrame) -> DataFrame:
    """Latest beaten event of any kind per station; on one day the first kind in order wins."""
    return (
        events.filter(is_beaten())
        .groupBy("station_id")
        .agg(_newest_beaten().alias("last"))
        .select(
            "station_id", "last.obs_date", "last.kind", "last.month", "last.value",
            "last.provisional",
        )
    )


def _newest_beaten() -> Column:
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    newest = F.struct("obs_date", (-rank).alias("rank"), "kind", "month", "value", "provisional")
    return F.max(F.when(is_beaten(), newest))


def event_timeline(events: DataFrame) -> DataFrame:
    """The whole ladder; rungs that beat nothing are marked ``initial``."""
    return events.select(*EVENT_COLUMNS, (~is_beaten()).alias("initial"))


def station_documents(
    events: DataFrame,
    coverage: DataFrame,
    stations: DataFrame,
    gaps: DataFrame,
    p: RunParams,
) -> DataFrame:
    """One nested row per active station.

    All that the ladder gives (totals, last, current and monthly records, timeline) comes from one
    aggregation of it per station, in which only the timeline grows with the events. Arrays are
    bounded by the calendar: at most four events a day and one gap per ``export_gap_min_days`` days.
    """

    def newest(when: Column) -> Column:
        return _last(["value", "provisional"], when)

    newest_first = (-F.unix_date("obs_date")).alias("order")
    event = F.struct(
        newest_first, "kind", "month", "obs_date", "value", "prev_value",
        "days_since_prev", "provisional", (~is_beaten()).alias("initial"),
    )
    per_station = events.groupBy("station_id").agg(
        *_totals(p),
        *[newest(is_all_time() & (family() == f)).alias(f"current_{f}") for f in FAMILIES],
        *[newest((F.col("month") == m) & (family() == f)).alias(f"month_{m}_{f}") for m in MONTHS for f in FAMILIES],
        _newest_beaten().alias("last"),
        F.sort_array(F.collect_list(event)).alias("events"),
    )
    gap_list = gaps.groupBy("station_id").agg(
        F.sort_array(F.collect_list(F.struct("gap_from", "gap_to", "n_days"))).alias("gaps")
    )
    joined = _active(coverage, stations).join(per_station, "station_id", "left").join(gap_list, "station_id", "left")

    def slot(month: int, which: str) -> Column:
        """The month's record, marked if it was set on the day of the current all-time one."""
        record = F.col(f"month_{month}_{which}")
        same = F.coalesce(record["obs_date"] == F.col(f"current_{which}.obs_date"), F.lit(False))
        return F.when(record.isNotNull(), record.withField("is_alltime", same)).alias(which)

    months = F.array(*[F.struct(F.lit(m).alias("month"), *[slot(m, f) for f in FAMILIES]) for m in MONTHS])
    last = F.struct(*[F.col(f"last.{c}") for c in ("obs_date", "kind", "month", "value", "provisional")])

    def empty_if_null(name: str) -> Column:
        return F.coalesce(F.col(name), F.array()).alias(name)

    return joined.select(
        *_summary_columns(),
        "current_max", "current_min",
        F.when(F.col("last").isNotNull(), last).alias("last_record"),
        months.alias("months"),
        empty_if_null("events"), empty_if_null("gaps"),
    )
