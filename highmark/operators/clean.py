"""Raw records to typed rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from highmark.functions import cleansing as C
from highmark.schemas import CLEAN_DAILY_COLUMNS, DAILY_NUMBER_FIELDS, DAILY_TEXT_FIELDS


def is_daily(station: Column, day: Column) -> Column:
    """Whether ``clean_daily`` takes a raw record: it has a station and a readable date."""
    return C.blank_to_null(station).isNotNull() & C.iso_date(C.blank_to_null(day)).isNotNull()


def clean_daily(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Typed daily rows; rows without a station or a readable date are dropped. ``keep`` names columns to go along."""
    columns = {
        name: C.blank_to_null(F.col(key)) for name, key in DAILY_TEXT_FIELDS.items()
    } | {name: C.decimal_text(F.col(key)) for name, key in DAILY_NUMBER_FIELDS.items()}
    columns["obs_date"] = C.iso_date(columns["obs_date"])
    return raw.select(*[columns[c].alias(c) for c in CLEAN_DAILY_COLUMNS], *keep).filter(
        F.col("station_id").isNotNull() & F.col("obs_date").isNotNull()
    )


def rejected_daily(raw: DataFrame) -> DataFrame:
    """Raw daily rows that ``clean_daily`` leaves out, with the reason."""
    station = C.blank_to_null(F.col(DAILY_TEXT_FIELDS["station_id"]))
    day = C.iso_date(C.blank_to_null(F.col(DAILY_TEXT_FIELDS["obs_date"])))
    reason = F.when(station.isNull(), "no station").when(day.isNull(), "no date")
    return raw.select("*", reason.alias("reason")).filter(F.col("reason").isNotNull())


def rejected_hourly(raw: DataFrame) -> DataFrame:
    """Raw hourly readings that ``clean_hourly`` leaves out, with the reason."""
    reason = F.when(C.blank_to_null(F.col("idema")).isNull(), "no station").when(
        C.offset_instant(F.col("fint")).isNull(), "no instant"
    )
    return raw.select("*", reason.alias("reason")).filter(F.col("reason").isNotNull())


def clean_stations(raw: DataFrame) -> DataFrame:
    """Typed station rows; rows without an id are dropped."""

    def text(key: str) -> F.Column:
        return C.blank_to_null(C.stripped(F.col(key)))

    return raw.select(
        C.blank_to_null(F.col("indicativo")).alias("station_id"),
        text("nombre").alias("name"),
        text("provincia").alias("province"),
        C.integer_text(F.col("altitud")).alias("altitude"),
        C.coordinate_text(F.col("latitud")).alias("lat"),
        C.coordinate_text(F.col("longitud")).alias("lon"),
        text("indsinop").alias("synop_id"),
    ).filter(F.col("station_id").isNotNull())


def clean_hourly(raw: DataFrame) -> DataFrame:
    """Typed hourly readings; readings without a station or a readable instant are dropped."""
    return raw.select(
        C.blank_to_null(F.col("idema")).alias("station_id"),
        C.offset_instant(F.col("fint")).alias("instant"),
        C.decimal_text(F.col("ta").cast("string")).alias("ta"),
        C.decimal_text(F.col("tamax").cast("string")).alias("tamax"),
        C.decimal_text(F.col("tamin").cast("string")).alias("tamin"),
    ).filter(F.col("station_id").isNotNull() & F.col("instant").isNotNull())


def reading_extremes(readings: DataFrame) -> DataFrame:
    """Highest and lowest candidate of each single reading."""
    return readings.withColumns(
        {"high": F.greatest("tamax", "ta"), "low": F.least("tamin", "ta")}
    )


def hourly_daily_extremes(hourly: DataFrame, tz: str) -> DataFrame:
    """Extremes per station and local calendar day of raw hourly readings."""
    return (
        reading_extremes(clean_hourly(hourly))
        .groupBy(
            "station_id", F.to_date(C.local_clock(F.col("instant"), tz)).alias("obs_date")
        )
        .agg(F.max("high").alias("tmax"), F.min("low").alias("tmin"))
        .filter(F.col("tmax").isNotNull() | F.col("tmin").isNotNull())
    )
