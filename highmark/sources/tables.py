"""Stored tables: partitioned observations, snapshots and restores."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from highmark.operators.resolve import conform
from highmark.schemas import (
    HISTORY_LEDGER, MONTH_LEDGER, OBSERVATIONS, STATION_MAP, STATIONS,
)

# The tables a snapshot holds; everything else is derived from them.
SOURCE_SCHEMAS = {
    "observations": OBSERVATIONS,
    "stations": STATIONS,
    "month_ledger": MONTH_LEDGER,
    "history_ledger": HISTORY_LEDGER,
}
DEFAULTS = {"observations": {"provisional": False}}


def write_observations(obs: DataFrame, path: str, files_per_year: int | None = None) -> None:
    """Observations by year, sorted within each file so that footers prune by station.

    By default adaptive execution sizes the files: it splits years that are large and merges what
    is small. ``files_per_year`` sets their number by hash instead.
    """
    rows = conform(obs, OBSERVATIONS, DEFAULTS["observations"]).withColumn("year", F.year("obs_date"))
    if files_per_year is None:
        rows = rows.hint("rebalance", F.col("year"), F.col("station_id"))
    else:
        rows = rows.repartition("year", F.pmod(F.xxhash64("station_id"), F.lit(files_per_year)))
    (
        rows.sortWithinPartitions("year", "station_id", "obs_date")
        .write.mode("errorifexists")
        .option("compression", "zstd")
        .partitionBy("year")
        .parquet(path)
    )


def read_observations(spark: SparkSession, path: str) -> DataFrame:
    """Declared columns and ``year``, by which readers that filter or join on it prune files."""
    dated = T.StructType([*OBSERVATIONS.fields, T.StructField("year", T.IntegerType())])
    return conform(spark.read.parquet(path), dated, DEFAULTS["observations"])


def _stored_or_empty(spark: SparkSession, path: str, schema) -> DataFrame:
    """The table at ``path``, empty if there is no such path; whatever else is wrong is raised."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def snapshot(tables: Mapping[str, DataFrame], path: str) -> None:
    """Write source tables as compressed parquet, one folder each; never over existing data."""
    unknown = set(tables) - set(SOURCE_SCHEMAS)
    if unknown:
        raise ValueError(f"not source tables: {sorted(unknown)}")
    for name, table in tables.items():
        table.write.mode("errorifexists").option("compression", "zstd").parquet(f"{path}/{name}")


def restore(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Tables of a snapshot, by column name; a missing table comes back empty."""
    tables = {}
    for name, schema in SOURCE_SCHEMAS.items():
        tables[name] = conform(_stored_or_empty(spark, f"{path}/{name}", schema), schema, DEFAULTS.get(name))
    return tables


def restore_into(spark: SparkSession, path: str, target: str) -> dict[str, DataFrame]:
    """Restore into a new store; refuses to mix with one that is already there."""
    for name, table in restore(spark, path).items():
        table.write.mode("errorifexists").option("compression", "zstd").parquet(f"{target}/{name}")
    return {name: spark.read.parquet(f"{target}/{name}") for name in SOURCE_SCHEMAS}


def load_station_map(spark: SparkSession, path: str) -> DataFrame:
    """The stored summary-name map; before the first one is stored, an empty map."""
    return conform(_stored_or_empty(spark, path, STATION_MAP), STATION_MAP)


def save_station_map(station_map: DataFrame, path: str) -> None:
    """A new map version; ``path`` must be a new folder, so readers of the old one go on."""
    station_map.write.mode("errorifexists").option("compression", "zstd").parquet(path)
