"""Yearly and monthly aggregates per station group, and their dense grid.

Facts are first reduced to one row per station and period. That reduction is combined
before the shuffle, removes every DISTINCT (a station then counts once per period), and
leaves few rows to join with the station dimension.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from highmark.functions.cleansing import accent_free_key
from highmark.functions.predicates import has_temperature, is_beaten, is_definitive
from highmark.params import RunParams
from highmark.schemas import ALL_MAX, ALL_MIN, KINDS, MONTH_MAX, MONTH_MIN

TOTAL = "total"
# Name of the total group and order of the grid's row fields.
TOTAL_NAME = "Todas las estaciones"
ROW_FIELDS = {
    "absolutoMax": "all_max",
    "absolutoMin": "all_min",
    "mensualMax": "month_max",
    "mensualMin": "month_min",
    "estacionesConDatos": "n_stations",
    "estacionesBatieronMax": "stations_max",
    "estacionesBatieronMin": "stations_min",
}
GRID_COLUMNS = list(ROW_FIELDS.values())


def period_columns(monthly: bool) -> list[str]:
    return ["year", "month"] if monthly else ["year"]


def group_lookup(stations: DataFrame, aliases: DataFrame) -> DataFrame:
    """Group of every station; NULL for a province without an alias."""
    lookup = aliases.select(F.col("alias").alias("province"), "group_id")
    return stations.join(lookup, "province", "left").select("station_id", "group_id")


def _dated(df: DataFrame, p: RunParams) -> DataFrame:
    """Rows from ``min_year`` on; a stored table's own ``year`` prunes its partitions."""
    first_day = F.make_date(F.lit(p.min_year), F.lit(1), F.lit(1))
    kept = df.filter(F.col("obs_date") >= first_day)
    if "year" in df.columns:
        kept = kept.filter(F.col("year") >= p.min_year)
    return kept.withColumns({"year": F.year("obs_date"), "obs_month": F.month("obs_date")})


def _per_station(df: DataFrame, monthly: bool) -> list[Column]:
    """Keys of a fact after ``_dated``."""
    keys = [F.col("station_id"), F.col("year")]
    return keys + [F.col("obs_month").alias("month")] if monthly else keys


def _cells(
    per_station: DataFrame, groups: DataFrame, monthly: bool, aggs: dict[str, Column]
) -> DataFrame:
    """Cells per group and, in the same pass, per period over all groups."""
    period = [F.col(c) for c in period_columns(monthly)]
    return (
        per_station.join(groups, "station_id")
        .groupingSets([[*period, F.col("group_id")], period], *period, F.col("group_id"))
        .agg(
            F.grouping("group_id").cast("int").alias("is_total"),
            *[agg.alias(name) for name, agg in aggs.items()],
        )
        .select(*period_columns(monthly), "group_id", "is_total", *aggs)
    )


def records_by_period_group(
    events: DataFrame, groups: DataFrame, p: RunParams, monthly: bool
) -> DataFrame:
    """Beaten definitive records by kind, and how many stations beat a day or night record."""
    beaten = _dated(events.filter(is_beaten() & is_definitive()), p)
    per_station = beaten.groupBy(*_per_station(beaten, monthly)).agg(
        *[F.count_if(F.col("kind") == k).alias(k) for k in KINDS]
    )
    beat_max = F.col(ALL_MAX) + F.col(MONTH_MAX) > 0
    beat_min = F.col(ALL_MIN) + F.col(MONTH_MIN) > 0
    aggs = {k: F.sum(k) for k in KINDS}
    aggs |= {"stations_max": F.count_if(beat_max), "stations_min": F.count_if(beat_min)}
    return _cells(per_station, groups, monthly, aggs)


def definitive_months(obs: DataFrame) -> DataFrame:
    """Months in which a station has a definitive temperature: all that the counts below need."""
    return (
        obs.filter(has_temperature() & is_definitive())
        .select(
            "station_id", F.year("obs_date").alias("year"), F.month("obs_date").alias("month")
        )
        .distinct()
    )


def stations_by_period_group(
    obs: DataFrame,
    groups: DataFrame,
    p: RunParams,
    monthly: bool,
    months: DataFrame | None = None,
) -> DataFrame:
    """Stations with a definitive temperature; ``months`` saves another pass over ``obs``."""
    if months is None:
        days = _dated(obs.filter(has_temperature() & is_definitive()), p)
        periods = days.select(*_per_station(days, monthly))
    else:
        kept = months.filter(F.col("year") >= p.min_year)
        periods = kept.select("station_id", *period_columns(monthly))
    return _cells(periods.distinct(), groups, monthly, {"n_stations": F.count(F.lit(1))})


def group_meta(
    obs: DataFrame,
    groups: DataFrame,
    aliases: DataFrame,
    names: DataFrame,
    months: DataFrame | None = None,
) -> DataFrame:
    """Every named group in display order, with its station count and sorted aliases."""
    seen = obs.filter(has_temperature() & is_definitive()) if months is None else months
    with_data = seen.select("station_id").distinct()
    counted = (
        groups.join(with_data, "station_id", "left_semi")
        .groupingSets([[F.col("group_id")], []], F.col("group_id"))
        .agg(F.grouping("group_id").alias("is_total"), F.count(F.lit(1)).alias("n"))
        .select(F.when(F.col("is_total") == 1, TOTAL).otherwise(F.col("group_id")).alias("group_id"), "n")
        .filter(F.col("group_id").isNotNull())
    )
    spelled = aliases.groupBy("group_id").agg(
        F.sort_array(F.collect_list("alias")).alias("aliases")
    )
    named = names.select("group_id", "name", accent_free_key(F.col("name")).alias("key"))
    spark = obs.sparkSession
    total = spark.range(1).select(
        F.lit(TOTAL).alias("group_id"), F.lit(TOTAL_NAME).alias("name"), F.lit("").alias("key")
    )
    listed = (
        total.unionByName(named)
        .join(counted, "group_id", "left")
        .join(spelled, "group_id", "left")
        .select(
            F.struct((F.col("group_id") != TOTAL).alias("after_total"), "key", "group_id").alias("order"),
            "group_id",
            "name",
            F.coalesce("n", F.lit(0)).cast("bigint").alias("n_stations"),
            F.coalesce("aliases", F.array().cast("array<string>")).alias("aliases"),
        )
    )
    # Groups are the fixed provinces plus the total, so one sorted array holds them.
    in_order = listed.agg(F.sort_array(F.collect_list(F.struct(*listed.columns))).alias("g"))
    return in_order.select(F.posexplode("g").alias("pos", "g")).select(
        "pos", "g.group_id", "g.name", "g.n_stations", "g.aliases"
    )


def _keyed(cells: DataFrame) -> DataFrame:
    """Cells under their group id; the row over all groups is the ``total`` group."""
    group = F.when(F.col("is_total") == 1, TOTAL).otherwise(F.col("group_id"))
    return cells.withColumn("group_id", group).drop("is_total").filter(F.col("group_id").isNotNull())


def year_axis(record_cells: DataFrame, station_cells: DataFrame) -> DataFrame:
    """One row with the sorted years that occur in either kind of cell."""
    years = _keyed(record_cells).select("year").union(_keyed(station_cells).select("year"))
    return years.agg(F.sort_array(F.collect_set("year")).alias("years"))


def dense_stats(
    record_cells: DataFrame,
    station_cells: DataFrame,
    group_ids: DataFrame,
    monthly: bool,
    years: DataFrame | None = None,
) -> DataFrame:
    """Every group and period of the axis with its seven counts, zero where nothing happened.

    ``years`` defaults to the years of the given cells; a monthly axis is all 12 months of
    each. The axis is one small array, unfolded per group, so no join builds the grid.
    """
    axis = (years if years is not None else year_axis(record_cells, station_cells)).scalar()
    grid = group_ids.select("group_id", F.explode(axis).alias("year"))
    if monthly:
        grid = grid.select("*", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("month"))
    keys = ["group_id", *period_columns(monthly)]
    filled = grid.join(_keyed(record_cells), keys, "left").join(_keyed(station_cells), keys, "left")
    return filled.select(
        *keys, *[F.coalesce(c, F.lit(0)).cast("int").alias(c) for c in GRID_COLUMNS]
    )


def as_row(columns: Sequence[str] = tuple(GRID_COLUMNS)) -> Column:
    """The seven counts as one fixed-order array."""
    return F.array(*[F.col(c) for c in columns])
