"""Coverage of a station: how much data it has, whether it is active, where it has gaps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from highmark.functions.predicates import has_temperature, is_beaten, is_definitive
from highmark.params import RunParams


def station_coverage(obs: DataFrame, p: RunParams) -> DataFrame:
    """First and last definitive day, day counts, and activity over the last 12 months."""
    recent = F.col("obs_date") >= F.add_months(F.lit(p.as_of), -12)
    return (
        obs.filter(has_temperature() & is_definitive())
        .groupBy("station_id")
        .agg(
            F.min("obs_date").alias("first_date"),
            F.max("obs_date").alias("last_date"),
            F.count(F.lit(1)).alias("n_days"),
            F.count_if(recent).alias("n_days_12m"),
        )
        .withColumn("is_active", F.col("n_days_12m") >= p.active_min_days)
    )


def coverage_gaps(obs: DataFrame, p: RunParams) -> DataFrame:
    """Interior runs of at least ``export_gap_min_days`` days without any temperature.

    Gaps inside a (station, year) block are found there. Only those and the edge days
    of each block travel on to the station, so a long series is not one task's work.
    """
    block = Window.partitionBy("station_id", "year").orderBy("obs_date")
    station = Window.partitionBy("station_id").orderBy("obs_date")
    edges = (
        obs.filter(has_temperature())
        .select("station_id", "obs_date", F.year("obs_date").alias("year"))
        .withColumn("before", F.lag("obs_date").over(block))
        .withColumn("after", F.lead("obs_date").over(block))
        .filter(
            F.col("before").isNull()
            | F.col("after").isNull()
            | (F.datediff("obs_date", "before") > p.export_gap_min_days)
        )
    )
    n_days = F.datediff("obs_date", "before") - 1
    return (
        edges.withColumn(
            "before", F.coalesce("before", F.lag("obs_date").over(station))
        )
        .filter(n_days >= p.export_gap_min_days)
        .select(
            "station_id",
            F.date_add("before", 1).alias("gap_from"),
            F.date_sub("obs_date", 1).alias("gap_to"),
            n_days.alias("n_days"),
        )
    )


def dataset_figures(obs: DataFrame, events: DataFrame, coverage: DataFrame) -> DataFrame:
    """One row of totals for the run; three files are written besides one per active station."""
    stations = coverage.agg(
        F.count_if("is_active").alias("n_active"),
        F.count(F.lit(1)).alias("n_history"),
        F.max("last_date").alias("last_date"),
    )
    years = obs.filter(is_definitive()).agg(
        F.year(F.min("obs_date")).alias("year_min"),
        F.year(F.max("obs_date")).alias("year_max"),
    )
    beaten = events.filter(is_beaten()).agg(F.count(F.lit(1)).alias("n_beaten"))
    return stations.select(
        "n_active",
        "n_history",
        years.select("year_min").scalar().alias("year_min"),
        years.select("year_max").scalar().alias("year_max"),
        "last_date",
        beaten.scalar().alias("n_beaten"),
        (F.col("n_active") + 3).alias("n_files"),
    )
