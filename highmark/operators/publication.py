"""What a publication has to write and to remove."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Paths of the published documents.
ROOT_DOCUMENTS = ("stations.json", "stats.json", "rankings.json")
STATION_FOLDER = "stations/"


def document_manifest(coverage: DataFrame, stations: DataFrame) -> DataFrame:
    """Paths of this run: the three root documents and one per active station."""
    active = stations.select("station_id").join(
        coverage.filter("is_active").select("station_id"), "station_id", "left_semi"
    )
    per_station = active.select(
        F.concat(F.lit(STATION_FOLDER), "station_id", F.lit(".json")).alias("path")
    )
    spark = coverage.sparkSession
    root = spark.range(1).select(F.explode(F.array(*map(F.lit, ROOT_DOCUMENTS))).alias("path"))
    return per_station.unionByName(root)


def publication_delta(current: DataFrame, published: DataFrame) -> DataFrame:
    """Write everything current; delete station documents that are no longer produced."""
    gone = (
        published.filter(F.col("path").like(f"{STATION_FOLDER}%.json"))
        .select("path")
        .join(current.select("path"), "path", "left_anti")
    )
    return current.select("path", F.lit("put").alias("action")).unionByName(
        gone.select("path", F.lit("delete").alias("action"))
    )
