"""Loads of landed pages: the chunks of the incremental window, and the half-years of single stations.

What a page turned out to be is data: rows, nothing, or unreadable. The next plan is made from it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from highmark.operators import planning
from highmark.operators.clean import clean_daily
from highmark.operators.planning import FAILED
from highmark.operators.resolve import as_observations
from highmark.params import RunParams
from highmark.schemas import CHUNK_LEDGER
from highmark.session import work_folder
from highmark.sources.readers import LOADED, read_named_pages, read_pages


@dataclass
class PageLoad:
    """Definitive rows for the log, ledger rows to append after them, and what became of each page."""

    rows: DataFrame
    ledger: DataFrame
    pages: DataFrame


def _rows(raw: DataFrame, taken: DataFrame, keys: list[str], seq: int) -> DataFrame:
    """Definitive rows of the pages in ``taken``."""
    return _definitive(raw.join(taken.select(*keys), keys, "left_semi"), seq)


def _definitive(raw: DataFrame, seq: int) -> DataFrame:
    return as_observations(clean_daily(raw), provisional=False).withColumn("seq", F.lit(seq).cast("bigint"))


def _named(windows: DataFrame) -> DataFrame:
    """The pages of windows, by the names they land under."""
    return windows.select(F.col("station_id").alias("station"), F.col("win_start").alias("page_start"))


def _stored(outcomes: DataFrame) -> DataFrame:
    """Outcomes, a few bytes a page, written so that the pages are read for them once."""
    folder = work_folder(outcomes.sparkSession, "outcomes")
    outcomes.write.parquet(folder)
    return outcomes.sparkSession.read.schema(outcomes.schema).parquet(folder)


def load_chunks(spark: SparkSession, base: str, chunks: DataFrame, seq: int) -> PageLoad:
    """Pages ``base/<chunk_start>.json`` of the planned chunks. A chunk whose page is missing has failed, too."""
    outcomes, raw = read_pages(spark, base)
    named = outcomes.withColumnRenamed("page_start", "chunk_start")
    pages = chunks.join(named, "chunk_start", "left").select(
        "chunk_start", "chunk_end", F.coalesce("outcome", F.lit(FAILED)).alias("outcome"), F.coalesce("n_rows", F.lit(0)).alias("n_rows")
    )
    ledger = pages.withColumn("seq", F.lit(seq).cast("bigint")).select(CHUNK_LEDGER.names)
    taken = pages.filter(F.col("outcome") == LOADED).withColumnRenamed("chunk_start", "page_start")
    return PageLoad(_rows(raw, taken, ["page_start"], seq), ledger, pages)


def load_history(
    spark: SparkSession,
    base: str,
    obs: DataFrame,
    ledger_log: DataFrame,
    p: RunParams,
    seq: int,
    include_complete: bool = False,
    include_all: bool = False,
    chosen: DataFrame | None = None,
) -> PageLoad:
    """Pages ``base/station=<id>/<first day of the half-year>.json`` of the stations whose history is pending.

    A station is walked from its newest window back. An unreadable page is neither empty nor a hit. A window
    whose page has not landed interrupts the walk: newer pages are taken, the station stays started, and
    the next run goes on from its series, which begins earlier by then. A station is finished where
    ``empty_stop`` empty windows follow each other, or its windows are used up. ``pages`` has the walked
    windows. The pages' names follow from the plan: executors open them by name, and no folder is listed. What
    has landed is looked up once, when this is called. Starts get ``seq`` in the ledger, finishes ``seq + 1``;
    append the starts before the rows go in.
    """
    if chosen is None:
        targets = planning.history_targets(obs, planning.history_ledger(ledger_log), p, include_complete, include_all)
    else:
        targets = planning.selected_targets(obs, chosen, p)
    keys = ["station_id", "win_start"]
    windows = planning.half_year_windows(targets, p)
    outcomes, _ = read_named_pages(_named(windows), base, "station", "page_start")
    named = _stored(outcomes).withColumnsRenamed({"station": "station_id", "page_start": "win_start"})
    seen = windows.join(named, keys, "left")
    # the windows of a station number two a year
    hole = F.min(F.when(F.col("outcome").isNull(), F.col("n"))).over(Window.partitionBy("station_id"))
    seen = seen.withColumn("hole", hole)
    landed = seen.filter(F.col("hole").isNull() | (F.col("n") < F.col("hole")))
    walked = planning.walk_windows(
        landed.withColumn("failed", F.col("outcome") == FAILED).withColumn("n_rows", F.when(F.col("outcome") == LOADED, F.col("n_rows"))), p
    )
    pages = walked.select("station_id", "win_start", "win_end", "n", "outcome", "n_rows", "exhausted")
    done = (
        targets.join(seen.groupBy("station_id").agg(F.count("hole").alias("holes")), "station_id", "left")
        .join(pages.groupBy("station_id").agg(F.bool_or("exhausted").alias("exhausted")), "station_id", "left")
        .join(planning.history_outcome(pages), "station_id", "left")
        .filter(F.coalesce("exhausted", F.lit(False)) | (F.coalesce("holes", F.lit(0)) == 0))
        .select("station_id", "earliest", F.coalesce("n_rows", F.lit(0)).alias("n_rows"))
    )
    ledger = planning.history_started(targets, F.lit(seq)).unionByName(planning.history_finished(done, F.lit(seq + 1)))
    _, raw = read_named_pages(_named(pages.filter(F.col("outcome") == LOADED)), base, "station", "page_start")
    return PageLoad(_definitive(raw, seq), ledger, pages)
