"""Every job of the library over the stand-in tables: name -> callable(spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import standins as X
from highmark.operators import (
    clean, coverage, ladder, planning, publication, rankings, resolve, stats,
)
from highmark.operators import stations as st
from highmark.params import RunParams
from highmark.plans import bulk, daily, documents, incremental, landed
from highmark.schemas import ALL_MAX, ALL_MIN, CHUNK_LEDGER, MONTH_MAX, MONTH_MIN, OBSERVATIONS, RAW_DAILY, RAW_HOURLY
from highmark.session import settle, work_folder
from highmark.sources import files, readers, summaries, tables
from highmark.streaming import intraday

Query = Callable[[SparkSession, str], DataFrame]
PARAMS = {"part": X.PART, "supplier": X.SUPPLIER}
PREVIOUS_RUN = X.AS_OF - timedelta(days=180)


class Run:
    """The inputs and derived tables of one role.

    Lazy, except that documents read the ladder and its companions many times: for them
    the tables are ``stored``, as in the daily cycle.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, role: str, stored: bool = False):
        settle(spark)
        self.spark = spark
        self.folder = work_folder(spark, role) if stored else None
        self.p = PARAMS[role]
        self.obs = self.keep("obs", X.observations(spark, sf_dir, role))
        self.stations = X.stations(spark, sf_dir, role)
        self.events = self.keep("events", ladder.record_events(self.obs, self.p))
        self.coverage = self.keep("coverage", coverage.station_coverage(self.obs, self.p))
        self.read_model = (self.events, self.coverage, self.stations)
        if role == "supplier":
            self.aliases = X.aliases(spark, sf_dir)
            self.names = X.group_names(spark, sf_dir)
            self.groups = stats.group_lookup(self.stations, self.aliases)

    def keep(self, name: str, table: DataFrame) -> DataFrame:
        if self.folder is None:
            return table
        table.write.parquet(f"{self.folder}/{name}")
        return self.spark.read.parquet(f"{self.folder}/{name}")


def _over(role: str, job: Callable[[Run], DataFrame], stored: bool = False) -> Query:
    return lambda spark, sf_dir: job(Run(spark, sf_dir, role, stored))


def _from(source: Callable[[SparkSession, str], DataFrame], job: Callable[[DataFrame], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        settle(spark)
        return job(source(spark, sf_dir))

    return run


def _new_events(r: Run) -> DataFrame:
    before = r.obs.filter(F.col("obs_date") <= F.lit(PREVIOUS_RUN))
    return ladder.new_record_events(r.events, ladder.record_events(before, r.p))


def _refreshed(r: Run) -> DataFrame:
    before = ladder.record_events(r.obs.filter(F.col("obs_date") <= F.lit(PREVIOUS_RUN)), r.p)
    changed = r.obs.filter(F.col("obs_date") > F.lit(PREVIOUS_RUN))
    return ladder.refresh_record_events(r.obs, before, changed, r.p)


def _record_cells(monthly: bool) -> Query:
    return _over("supplier", lambda r: stats.records_by_period_group(r.events, r.groups, r.p, monthly))


def _station_cells(monthly: bool) -> Query:
    return _over("supplier", lambda r: stats.stations_by_period_group(r.obs, r.groups, r.p, monthly))


def _dense(monthly: bool) -> Query:
    def job(r: Run) -> DataFrame:
        ids = stats.group_meta(r.obs, r.groups, r.aliases, r.names).select("group_id")
        return stats.dense_stats(
            stats.records_by_period_group(r.events, r.groups, r.p, monthly),
            stats.stations_by_period_group(r.obs, r.groups, r.p, monthly),
            ids,
            monthly,
        )

    return _over("supplier", job)


def _group_meta(r: Run) -> DataFrame:
    meta = stats.group_meta(r.obs, r.groups, r.aliases, r.names)
    return meta.withColumn("aliases", F.array_join("aliases", ","))


def _stats_document(r: Run) -> DataFrame:
    tables = documents.stats_tables(
        r.obs, r.events, r.groups, r.aliases, r.names, r.p, store=r.keep
    )
    return documents.stats_json(documents.stats_document(tables))


def _rankings_document(r: Run) -> DataFrame:
    return documents.rankings_json(documents.rankings_document(*r.read_model, r.p))


def _rankings_reduced(r: Run) -> DataFrame:
    return documents.rankings_json(documents.rankings_document(*r.read_model, r.p, store=r.keep))


def _station_documents(r: Run) -> DataFrame:
    gaps = coverage.coverage_gaps(r.obs, r.p)
    return documents.station_json(st.station_documents(*r.read_model, gaps, r.p))


def _parsed(files: DataFrame) -> DataFrame:
    def store(rows: DataFrame) -> DataFrame:
        path = work_folder(rows.sparkSession, "summary")
        rows.write.parquet(path)
        return rows.sparkSession.read.schema(rows.schema).parquet(path)

    return summaries.parse_daily_summary(files, store)


def _site(r: Run) -> DataFrame:
    """Files of a site where every station had a document and only active ones still have: path and text, read back."""
    base = work_folder(r.spark, "site")
    path = F.concat(F.lit(publication.STATION_FOLDER), "station_id", F.lit(".json")).alias("path")
    before = r.stations.select(path, F.lit("{}").alias("text"))
    files.write_files(before, base)
    files.write_files(_station_documents(r).select(path, "text"), base)
    delta = publication.publication_delta(publication.document_manifest(r.coverage, r.stations), before)
    files.delete_files(delta, base)
    found = r.spark.read.option("wholetext", True).text(f"{base}/stations").select(
        F.regexp_extract(F.col("_metadata.file_path"), r"/([^/]+)[.]json$", 1).alias("station_id"), F.col("value").alias("text")
    )
    return found


def _restored_into(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stations restored into a new store, and whether a second restore into it is refused."""
    settle(spark)
    folder = work_folder(spark, "restore")
    tables.snapshot({"stations": X.stations(spark, sf_dir, "part")}, f"{folder}/snapshot")
    restored = tables.restore_into(spark, f"{folder}/snapshot", f"{folder}/store")["stations"]
    try:
        tables.restore_into(spark, f"{folder}/snapshot", f"{folder}/store")
        refused = False
    except AnalysisException as error:
        refused = error.getCondition() == "PATH_ALREADY_EXISTS"
    return restored.withColumn("refused", F.lit(refused))


def _station_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.extract_station_map(X.station_pages(spark, sf_dir), min_rows=0)


def _match(which: int) -> Query:
    """Names of region 4 are missing from the map."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        settle(spark)
        named = X.summary_names(spark, sf_dir)
        summary = X.observations(spark, sf_dir, "supplier").join(named, "station_id").drop("station_id")
        known = X.aliases(spark, sf_dir).select(F.col("alias").alias("province"))
        station_map = named.join(known, "province", "left_semi")
        p = X.replace(X.SUPPLIER, summary_max_offset_days=1500)
        return summaries.match_summary_stations(summary, station_map, p)[which]

    return run


def _stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hourly job as a stream over the event file, read back from the ingest log."""
    settle(spark)
    schema = X.table(spark, sf_dir, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    folder = work_folder(spark, "hourly")
    intraday.ingest_hourly(
        X.as_hourly(events), f"{folder}/log", f"{folder}/checkpoint", X.PART
    ).awaitTermination()
    resolved = resolve.resolve_observations(intraday.read_log(spark, f"{folder}/log"))
    return resolved.select("station_id", "obs_date", "tmax", "tmin")


def _live_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hourly job over six files, one a trigger: days before and after the live ones go around the state."""
    settle(spark)
    folder = work_folder(spark, "live")
    X.as_hourly(X.table(spark, sf_dir, "events").repartitionByRange(6, "ts")).write.parquet(f"{folder}/landing")
    stream = spark.readStream.schema(RAW_HOURLY).option("maxFilesPerTrigger", 1).parquet(f"{folder}/landing")
    p = X.replace(X.PART, as_of=X.LIVE_DAY)
    for query in intraday.ingest_live(stream, f"{folder}/log", f"{folder}/checkpoint", p):
        query.awaitTermination()
    resolved = resolve.resolve_observations(intraday.read_log(spark, f"{folder}/log"))
    return resolved.select("station_id", "obs_date", "tmax", "tmin")


def _both_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings and daily records as two streams into one log; what is definitive replaces what was read."""
    settle(spark)
    folder = work_folder(spark, "streams")
    X.raw_hourly(spark, sf_dir).write.parquet(f"{folder}/hourly")
    X.hourly_confirmations(spark, sf_dir).write.parquet(f"{folder}/daily")
    daily_rows = spark.readStream.schema(RAW_DAILY).parquet(f"{folder}/daily")
    hourly = spark.readStream.schema(RAW_HOURLY).parquet(f"{folder}/hourly")
    intraday.ingest_daily(daily_rows, f"{folder}/log", f"{folder}/daily-checkpoint").awaitTermination()
    intraday.ingest_hourly(hourly, f"{folder}/log", f"{folder}/hourly-checkpoint", X.PART).awaitTermination()
    resolved = resolve.resolve_observations(intraday.read_log(spark, f"{folder}/log"))
    return resolved.select("station_id", "obs_date", "tmax", "tmin", "provisional")


def _merge(job: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        settle(spark)
        current = X.observations(spark, sf_dir, "supplier")
        return job(current, X.incoming_provisional(spark, sf_dir))

    return run


def _snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    settle(spark)
    folder = work_folder(spark, "snapshot")
    obs = resolve.as_observations(X.observations(spark, sf_dir, "part"))
    tables.snapshot({"observations": obs}, folder)
    return tables.restore(spark, folder)["observations"].select(
        "station_id", "obs_date", "tmax", "tmin", "provisional"
    )


def _snapshot_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and keys of all four source tables after a snapshot and a restore."""
    settle(spark)
    folder = work_folder(spark, "snapshot")
    tables.snapshot(
        {
            "observations": resolve.as_observations(X.observations(spark, sf_dir, "part")),
            "stations": X.stations(spark, sf_dir, "part"),
            "month_ledger": X.month_log(spark, sf_dir),
            "history_ledger": X.history_log(spark, sf_dir),
        },
        folder,
    )
    keys = {"observations": ["station_id"], "stations": ["station_id"], "month_ledger": ["year", "month"], "history_ledger": ["station_id"]}
    parts = [
        table.agg(F.lit(name).alias("source"), F.count(F.lit(1)).alias("n_rows"), F.countDistinct(*keys[name]).alias("n_keys"))
        for name, table in tables.restore(spark, folder).items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


def _months_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    settle(spark)
    rows = clean.clean_daily(X.raw_daily(spark, sf_dir))
    return planning.months_loaded(X.months(spark, sf_dir), rows, F.lit(7))


def _refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored map lacks the names of region 4, the fresh one has all."""
    settle(spark)
    named = X.summary_names(spark, sf_dir)
    summary = X.observations(spark, sf_dir, "supplier").join(named, "station_id").drop("station_id")
    known = X.aliases(spark, sf_dir).select(F.col("alias").alias("province"))
    p = X.replace(X.SUPPLIER, summary_max_offset_days=1500)
    return summaries.match_with_refresh(summary, named.join(known, "province", "left_semi"), named, p)[0]


def _history(**switches: bool) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        obs = X.observations(spark, sf_dir, "part")
        stored = obs.filter(F.col("obs_date") >= F.lit(X.HISTORY_CUT))
        archive = obs.filter(F.col("obs_date") < F.lit(X.HISTORY_CUT))
        ledger = planning.history_ledger(X.history_log(spark, sf_dir))
        return planning.history_plan(stored, ledger, X.HISTORY, archive=archive, **switches)

    return run


def _history_load(what: str) -> Query:
    """Landed half-years of the suppliers whose history is pending."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        settle(spark)
        base = work_folder(spark, "history")
        files.write_files(X.history_pages(spark, sf_dir), base)
        stored = X.observations(spark, sf_dir, "supplier").filter(F.col("obs_date") >= F.lit(X.HISTORY_CUT))
        load = landed.load_history(spark, base, stored, X.supplier_history_log(spark, sf_dir), X.HISTORY, 5)
        if what == "rows":
            return load.rows.select("station_id", "obs_date", "tmax", "tmin", "provisional", "seq")
        return getattr(load, what)

    return run


def _chunks(what: str) -> Query:
    """Landed chunks of the incremental window, and the plan after them."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        settle(spark)
        base = work_folder(spark, "chunks")
        stored = X.observations(spark, sf_dir, "supplier").filter(F.col("obs_date") <= F.lit(X.STORED_UNTIL)).withColumn("provisional", F.lit(False))
        none = spark.createDataFrame([], CHUNK_LEDGER)
        due = planning.chunks_due(stored, planning.chunk_ledger(none), X.CHUNKS)
        files.write_files(X.chunk_pages(spark, sf_dir, due), base)
        load = landed.load_chunks(spark, base, due, 1)
        if what == "rows":
            return load.rows.select("station_id", "obs_date", "tmax", "tmin", "provisional", "seq")
        if what == "ledger":
            return load.ledger
        now = resolve.as_observations(stored).unionByName(load.rows.drop("seq"))
        return planning.chunks_due(now, planning.chunk_ledger(load.ledger), X.CHUNKS)

    return run


def _bulk(what: str) -> Query:
    """The monthly archive as a landed tree; months before the stored part are in the ledger."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        settle(spark)
        base = work_folder(spark, "months")
        files.write_files(X.month_pages(spark, sf_dir), base)
        load = bulk.bulk_load(spark, base, X.month_log(spark, sf_dir), X.PART, 7)
        if what == "rows":
            return load.rows.select("station_id", "obs_date", "tmax", "tmin", "provisional", "seq")
        return getattr(load, what)

    return run


def _landed(pages: Callable[[SparkSession, str], DataFrame], job: Callable[[SparkSession, str], DataFrame]) -> Query:
    """Pages written to the shared folder, and a job over that folder."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        settle(spark)
        base = work_folder(spark, "landed")
        files.write_files(pages(spark, sf_dir), base)
        return job(spark, base)

    return run


def _months(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = planning.month_ledger(X.month_log(spark, sf_dir))
    return planning.months_to_load(X.months(spark, sf_dir), ledger, X.PART)


def _published(r: Run) -> DataFrame:
    """Documents of all stations, active or not, as the ones published before."""
    paths = r.stations.select(F.concat(F.lit("stations/"), "station_id", F.lit(".json")).alias("path"))
    return publication.publication_delta(publication.document_manifest(r.coverage, r.stations), paths)


def _cycle_inputs(r: Run, sf_dir: str) -> daily.CycleInputs:
    """Stored rows plus definitive, hourly and summary arrivals; the stored map lacks region 4."""
    names = X.summary_names(r.spark, sf_dir)
    known = r.aliases.select(F.col("alias").alias("province"))
    return daily.CycleInputs(
        aliases=r.aliases,
        names=r.names,
        observations=r.obs,
        stations=r.stations,
        raw_daily=X.confirmations(r.spark, sf_dir),
        raw_hourly=X.raw_hourly(r.spark, sf_dir),
        summary_files=X.summary_files(r.spark, sf_dir),
        station_map=names.join(known, "province", "left_semi"),
        fresh_map=names,
    )


def _cycle(what: str) -> Query:
    """A table at the end of a full cycle, with the ladder of an earlier day as the previous one."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        r = Run(spark, sf_dir, "supplier")
        inputs = _cycle_inputs(r, sf_dir)
        before = r.obs.filter(F.col("obs_date") <= F.lit(PREVIOUS_RUN))
        inputs.previous_events = ladder.record_events(before, r.p)
        p = X.replace(r.p, local_tz="UTC")
        return daily.daily_cycle(spark, inputs, p, work_folder(spark, "cycle"))[what]

    return run


def _cycle_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keyed table of a run after one that stored only its arrivals."""
    r = Run(spark, sf_dir, "supplier")
    p = X.replace(r.p, local_tz="UTC")
    inputs = _cycle_inputs(r, sf_dir)
    log = daily.arrivals(inputs, p)
    folder = work_folder(spark, "pending")
    log.write.parquet(folder)
    later = daily.CycleInputs(aliases=r.aliases, names=r.names, observations=r.obs, pending=spark.read.parquet(folder))
    table = daily.current_observations(later, daily.arrivals(later, p), p)
    return table.select("station_id", "obs_date", "tmax", "tmin", "provisional")


def _runs(job: Callable[[SparkSession, incremental.Cycle, RunParams], DataFrame]) -> Query:
    """After three runs into one store: a load, corrections of settled days, and a run that only adds."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        settle(spark)
        base = work_folder(spark, "store")
        for k, day in enumerate(X.RUN_DAYS):
            p = X.replace(X.SUPPLIER, as_of=day)
            log = resolve.conform(X.run_arrivals(spark, sf_dir, k), T.StructType([*OBSERVATIONS.fields, T.StructField("seq", T.LongType())]))
            last = incremental.run_cycle(spark, base, log, p)
        return job(spark, last, p)

    return run


def _run_counts(spark: SparkSession, last: incremental.Cycle, p: RunParams) -> DataFrame:
    return incremental.run_counts(last.record_events, last.record_events_new, coverage.station_coverage(last.observations, p))


def queries() -> dict[str, Query]:
    fetch = X.replace(X.SUPPLIER, chunk_days=4)
    result: dict[str, Query] = {
        # cleansing and sources
        "clean_daily": _from(X.raw_daily, clean.clean_daily),
        "clean_stations": _from(X.raw_stations, clean.clean_stations),
        "hourly_daily_extremes": _from(
            X.raw_hourly, lambda raw: clean.hourly_daily_extremes(raw, X.PART.local_tz)
        ),
        "stream_daily_extremes": _stream,
        "live_daily_extremes": _live_stream,
        "parse_daily_summary": _from(X.summary_files, _parsed),
        "parse_daily_summary_lazy": _from(X.summary_files, summaries.parse_daily_summary),
        "extract_station_map": _station_map,
        "match_summary_stations": _match(0),
        "unmatched_summary_stations": _match(1),
        # keyed table
        "resolve_observations": _from(X.ingest_log, resolve.resolve_observations),
        "merge_provisional": _merge(
            lambda current, incoming: resolve.merge_provisional(current, incoming).select(
                "station_id", "obs_date", "tmax", "tmin", "provisional"
            )
        ),
        "provisional_written": _merge(resolve.provisional_written),
        "purge_provisional": _over("part", lambda r: resolve.purge_provisional(r.obs, r.p)),
        "purged_count": _over("part", lambda r: resolve.purged_count(r.obs, r.p)),
        "snapshot_restore": _snapshot,
        "snapshot_tables": _snapshot_tables,
        "rejected_rows": _from(
            X.raw_daily, lambda raw: clean.rejected_daily(raw).select("indicativo", "fecha", "reason")
        ),
        "months_loaded": _months_loaded,
        "station_map_guard": _from(
            X.station_pages, lambda pages: summaries.extract_station_map(pages, min_rows=4, strict=False)
        ),
        "match_with_refresh": _refresh,
        # ladder and coverage
        "coverage_segments": _over("part", lambda r: ladder.coverage_segments(r.obs, r.p)),
        "record_events": _over("part", lambda r: r.events),
        "record_events_dense": _over("supplier", lambda r: r.events),
        "new_record_events": _over("part", _new_events),
        "refresh_record_events": _over("part", _refreshed),
        "station_coverage": _over("part", lambda r: r.coverage),
        "coverage_gaps": _over("supplier", lambda r: coverage.coverage_gaps(r.obs, r.p)),
        "dataset_figures": _over(
            "part", lambda r: coverage.dataset_figures(r.obs, r.events, r.coverage)
        ),
        # aggregates
        "group_lookup": _over("supplier", lambda r: r.groups),
        "records_by_year_group": _record_cells(False),
        "records_by_month_group": _record_cells(True),
        "stations_by_year_group": _station_cells(False),
        "stations_by_month_group": _station_cells(True),
        "group_meta": _over("supplier", _group_meta),
        "dense_stats_yearly": _dense(False),
        "dense_stats_monthly": _dense(True),
        "stats_document": _over("supplier", _stats_document, stored=True),
        # leaderboards
        "current_alltime_dates": _over("part", lambda r: rankings.current_alltime_dates(r.events)),
        "recent_records": _over("part", lambda r: rankings.recent_records(*r.read_model)),
        "largest_margins": _over("part", lambda r: rankings.largest_margins(*r.read_model)),
        "rankings_document": _over("part", _rankings_document, stored=True),
        "rankings_document_reduced": _over("part", _rankings_reduced, stored=True),
        # per-station read models
        "station_summary": _over("part", lambda r: st.station_summary(*r.read_model, r.p)),
        "current_alltime": _over("part", lambda r: st.current_alltime(r.events)),
        "current_monthly": _over("supplier", lambda r: st.current_monthly(r.events)),
        "last_record": _over("part", lambda r: st.last_record(r.events)),
        "event_timeline": _over("part", lambda r: st.event_timeline(r.events)),
        "station_documents": _over("supplier", _station_documents, stored=True),
        "publication_delta": _over("part", _published),
        "published_files": _over("supplier", _site, stored=True),
        "restore_into": _restored_into,
        "resolve_stations": _from(X.station_log, resolve.resolve_stations),
        "arrival_counts": _from(X.incoming_provisional, resolve.arrival_counts),
        "stream_definitive_supersedes": _both_streams,
        # planning
        "ingest_plan_months": _months,
        "ingest_plan_chunks": _over("supplier", lambda r: planning.fetch_chunks(r.obs, fetch)),
        "ingest_plan_days": _over("supplier", lambda r: planning.days_without_definitive(r.obs, X.replace(r.p, summary_back_days=20))),
        "history_plan": _history(),
        "history_plan_all": _history(include_all=True, include_complete=True),
        "history_load_rows": _history_load("rows"),
        "history_load_ledger": _history_load("ledger"),
        "history_load_pages": _history_load("pages"),
        "chunk_load_rows": _chunks("rows"),
        "chunk_load_ledger": _chunks("ledger"),
        "chunk_load_next_plan": _chunks("plan"),
        "bulk_load_rows": _bulk("rows"),
        "bulk_load_ledger": _bulk("ledger"),
        "bulk_load_failed": _bulk("failed"),
        "landed_stations": _landed(X.station_pages_json, lambda spark, base: clean.clean_stations(readers.read_stations(spark, base))),
        "landed_hourly": _landed(
            X.hourly_pages, lambda spark, base: clean.hourly_daily_extremes(readers.read_hourly(spark, base), X.PART.local_tz)
        ),
        "daily_cycle": _cycle("record_events"),
        "daily_cycle_new_events": _cycle("record_events_new"),
        "daily_cycle_pending": _cycle_pending,
        "versioned_ladder": _runs(lambda spark, last, p: last.record_events),
        "versioned_observations": _runs(
            lambda spark, last, p: last.observations.select("station_id", "obs_date", "tmax", "tmin", "provisional")
        ),
        "versioned_new_events": _runs(lambda spark, last, p: last.record_events_new),
        "versioned_run_counts": _runs(_run_counts),
        "versioned_station_ladder": _runs(lambda spark, last, p: incremental.station_ladder(spark, last.base, last.held, "1")),
    }
    for name, kind in (("max", ALL_MAX), ("min", ALL_MIN)):
        result[f"top_alltime_{name}"] = _over(
            "part", lambda r, k=kind: rankings.top_alltime(*r.read_model, k)
        )
        result[f"longest_standing_{name}"] = _over(
            "part", lambda r, k=kind: rankings.longest_standing(*r.read_model, k)
        )
    for name, kind in (("max", MONTH_MAX), ("min", MONTH_MIN)):
        result[f"top_by_month_{name}"] = _over(
            "part", lambda r, k=kind: rankings.top_by_month(*r.read_model, k)
        )
    for mode in ("year", "12m"):
        result[f"most_active_{mode}"] = _over(
            "part", lambda r, m=mode: rankings.most_active(*r.read_model, r.p, m)
        )
    return result
