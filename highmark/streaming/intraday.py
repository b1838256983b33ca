"""Structured Streaming: intraday extremes, live or batch by batch, and file-arrival ingest into the log.

The log is a folder tree ``source=<name>/stream=<id>/batch=<id>``. A batch that is repeated
after a failure overwrites its own folder, so each arrival is in the log once; a stream whose
checkpoint is new has a new id, so its batch numbers never meet those of an earlier one.
"""

from __future__ import annotations

from collections.abc import Callable
from threading import Event

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from highmark.functions.cleansing import local_clock
from highmark.operators.clean import clean_daily, clean_hourly, hourly_daily_extremes, reading_extremes
from highmark.operators.resolve import as_observations
from highmark.params import RunParams


def _next_seq(spark: SparkSession, log: str) -> int:
    """One more than the highest ``seq`` in the log, so that later runs count as later."""
    try:
        last = spark.read.parquet(log).agg(F.max("seq")).first()[0]
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        last = None  # nothing has been written yet
    return 0 if last is None else last + 1


def _append(
    stream: DataFrame,
    log: str,
    source: str,
    checkpoint: str,
    job: Callable[[DataFrame], DataFrame],
    provisional: bool,
    mode: str = "append",
) -> StreamingQuery:
    first_seq = _next_seq(stream.sparkSession, log)
    known, name = Event(), []

    def write(batch: DataFrame, batch_id: int) -> None:
        known.wait()
        rows = as_observations(job(batch), provisional)
        rows.withColumn("seq", F.lit(first_seq + batch_id).cast("bigint")).write.mode("overwrite").parquet(
            f"{log}/source={source}/stream={name[0]}/batch={batch_id}"
        )

    query = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )
    name.append(query.id)
    known.set()
    return query


def ingest_hourly(stream: DataFrame, log: str, checkpoint: str, p: RunParams) -> StreamingQuery:
    """Append the extremes of each arriving batch of readings to the log, as provisional rows.

    A batch is reduced on its own: provisional rows of a day merge when the log is resolved, so
    neither state nor a watermark is needed, and no reading is too late or too early.
    """
    return _append(stream, log, "hourly", checkpoint, lambda batch: hourly_daily_extremes(batch, p.local_tz), True)


def _is_live(day: str, p: RunParams) -> Column:
    """Days that may still change: within the provisional age, and not after tomorrow."""
    first, last = F.date_sub(F.lit(p.as_of), p.provisional_max_age_days), F.date_add(F.lit(p.as_of), 1)
    return F.col(day).between(first, last)


def live_extremes(stream: DataFrame, p: RunParams) -> DataFrame:
    """Extremes so far of every live station day, kept as state: a trigger gives the days it changed.

    The watermark follows the newest live reading at a distance of the provisional age and three days,
    so it drops the state of days that are no longer live, and never a reading of a day that is. A
    reading with a date far ahead is not live and cannot move it.
    """
    readings = reading_extremes(clean_hourly(stream)).withColumn("local_time", local_clock(F.col("instant"), p.local_tz))
    return (
        readings.withColumn("obs_date", F.to_date("local_time"))
        .filter(_is_live("obs_date", p) & (F.col("high").isNotNull() | F.col("low").isNotNull()))
        .withWatermark("local_time", f"{p.provisional_max_age_days + 3} days")
        .groupBy("station_id", F.window("local_time", "1 day").alias("day"))
        .agg(F.max("high").alias("tmax"), F.min("low").alias("tmin"))
        .select("station_id", F.to_date("day.start").alias("obs_date"), "tmax", "tmin")
    )


def ingest_live(stream: DataFrame, log: str, checkpoint: str, p: RunParams) -> tuple[StreamingQuery, StreamingQuery]:
    """Live days through their state, and all other readings reduced batch by batch, both into the log.

    What is too late or too early for the state is in the second query, so the log lacks nothing; as
    extremes only widen, what the state tells again merges with what it told before.
    """
    live = _append(live_extremes(stream, p), log, "live", f"{checkpoint}/live", lambda days: days, True, "update")

    def other_days(batch: DataFrame) -> DataFrame:
        return hourly_daily_extremes(batch, p.local_tz).filter(~_is_live("obs_date", p))

    return live, _append(stream, log, "hourly", f"{checkpoint}/other", other_days, True)


def live_view(spark: SparkSession, log: str) -> DataFrame:
    """Extremes of the live days as the state last told them, before anything is resolved."""
    told = spark.read.parquet(f"{log}/source=live")
    return told.groupBy("station_id", "obs_date").agg(F.max("tmax").alias("tmax"), F.min("tmin").alias("tmin"))


def ingest_daily(raw: DataFrame, log: str, checkpoint: str) -> StreamingQuery:
    """Append arriving daily batches to the log, as definitive rows."""
    return _append(raw, log, "daily", checkpoint, clean_daily, False)


def read_log(spark: SparkSession, log: str) -> DataFrame:
    """The ingest log, ready for ``resolve_observations``."""
    return spark.read.parquet(log).drop("source", "stream", "batch")
