"""The daily cycle: arrivals to table, ladder, aggregates, leaderboards, documents."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from highmark.operators import coverage as cov
from highmark.operators import ladder, planning, publication, resolve, stations as st, stats
from highmark.operators.clean import clean_daily, clean_stations, hourly_daily_extremes
from highmark.params import RunParams
from highmark.plans import documents as docs
from highmark.sources.files import delete_files, write_document, write_files
from highmark.sources.summaries import match_summary_stations, match_with_refresh, parse_daily_summary
from highmark.sources.tables import read_observations, write_observations


@dataclass
class CycleInputs:
    """Stored state and new arrivals; every arrival may be missing on its own.

    ``pending`` holds the arrivals of earlier runs that ``observations`` lacks because those
    runs did not rewrite it. ``fresh_map`` replaces ``station_map`` where that leaves names over.
    """

    aliases: DataFrame
    names: DataFrame
    observations: DataFrame | None = None
    pending: DataFrame | None = None
    stations: DataFrame | None = None
    previous_events: DataFrame | None = None
    published: DataFrame | None = None
    raw_daily: DataFrame | None = None
    raw_stations: DataFrame | None = None
    raw_hourly: DataFrame | None = None
    summary_files: DataFrame | None = None
    station_map: DataFrame | None = None
    fresh_map: DataFrame | None = None


def _provisional(
    inputs: CycleInputs, p: RunParams, store: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame | None:
    """Hourly and summary extremes as one arrival."""
    parts = []
    if inputs.raw_hourly is not None:
        parts.append(hourly_daily_extremes(inputs.raw_hourly, p.local_tz))
    if inputs.summary_files is not None and inputs.station_map is not None:
        summary = parse_daily_summary(inputs.summary_files, store)
        if inputs.fresh_map is None:
            matched, _ = match_summary_stations(summary, inputs.station_map, p)
        else:
            matched, _ = match_with_refresh(summary, inputs.station_map, inputs.fresh_map, p)
        parts.append(matched)
    if not parts:
        return None
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    return resolve.as_observations(merged, provisional=True)


def arrivals(
    inputs: CycleInputs, p: RunParams, store: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame | None:
    """New definitive and provisional rows after those still pending, as one numbered log.

    ``store`` keeps the rows of the summaries, see ``parse_daily_summary``.

    Stale provisional rows of earlier runs are purged; a definitive row always wins over a
    provisional one, so only the order of definitive arrivals matters.
    """
    parts = []
    if inputs.pending is not None:
        parts.append(resolve.purge_provisional(inputs.pending, p))
    fresh = [_provisional(inputs, p, store)]
    if inputs.raw_daily is not None:
        fresh.append(resolve.as_observations(clean_daily(inputs.raw_daily), provisional=False))
    next_seq = F.lit(0)
    if inputs.pending is not None:
        newest = inputs.pending.agg(F.max("seq").alias("seq"))
        next_seq = F.coalesce(newest.scalar(), F.lit(-1)) + 1
    parts += [d.withColumn("seq", next_seq.cast("bigint")) for d in fresh if d is not None]
    log = None
    for part in parts:
        log = part if log is None else log.unionByName(part)
    return log


def current_observations(
    inputs: CycleInputs, log: DataFrame | None, p: RunParams
) -> DataFrame:
    """The keyed table of this run: stored rows and the log, all resolved, without stale provisionals.

    Stored rows come before every arrival. A day is stale or not whatever its rows, so a purge of
    the resolved table also keeps purged rows from coming back.
    """
    parts = [] if log is None else [log]
    if inputs.observations is not None:
        stored = resolve.as_observations(inputs.observations)
        parts.insert(0, stored.withColumn("seq", F.lit(-1).cast("bigint")))
    if not parts:
        raise ValueError("nothing stored and nothing arrived")
    whole = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return resolve.purge_provisional(resolve.resolve_observations(whole), p)


def current_stations(inputs: CycleInputs) -> DataFrame:
    """Stored stations, replaced by fresh ones of the same id."""
    known = [inputs.stations] if inputs.stations is not None else []
    fresh = [clean_stations(inputs.raw_stations)] if inputs.raw_stations is not None else []
    numbered = [d.withColumn("seq", F.lit(i)) for i, d in enumerate(known + fresh)]
    if not numbered:
        raise ValueError("no stations stored and none arrived")
    log = numbered[0] if len(numbered) == 1 else numbered[0].unionByName(numbered[1])
    return resolve.resolve_stations(log)


def _stored(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    """Written and read back: later jobs start from the table, not from its lineage."""
    df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def daily_cycle(
    spark: SparkSession,
    inputs: CycleInputs,
    p: RunParams,
    out_dir: str,
    generated_at: str | None = None,
    publish_to: str | None = None,
    rewrite: bool = True,
) -> dict[str, DataFrame]:
    """Run everything into ``out_dir``, a new version folder on storage that all executors see.

    Nothing that is being read is overwritten. With ``publish_to`` (a URI) the documents
    are also written there as exactly named files, and stale ones are removed.

    ``rewrite`` stores the whole observation table anew. Without it only the arrivals are
    stored: hand them to the next run as ``pending``, and rewrite now and then.
    """
    log = arrivals(inputs, p, lambda rows: _stored(spark, rows, f"{out_dir}/summary_rows"))
    if log is not None:
        log = _stored(spark, log, f"{out_dir}/arrivals")
    obs = current_observations(inputs, log, p)
    if rewrite:
        write_observations(obs, f"{out_dir}/observations")
        obs = read_observations(spark, f"{out_dir}/observations")
    dim = _stored(spark, current_stations(inputs), f"{out_dir}/stations")
    coverage = _stored(spark, cov.station_coverage(obs, p), f"{out_dir}/station_coverage")
    events = _stored(spark, ladder.record_events(obs, p), f"{out_dir}/record_events")
    new_events = _stored(
        spark, ladder.new_record_events(events, inputs.previous_events), f"{out_dir}/record_events_new"
    )
    groups = stats.group_lookup(dim, inputs.aliases)
    stats_doc = docs.stats_document(
        docs.stats_tables(
            obs, events, groups, inputs.aliases, inputs.names, p,
            store=lambda name, table: _stored(spark, table, f"{out_dir}/stats_{name}"),
        ),
        generated_at,
    )
    rankings_doc = docs.rankings_document(events, coverage, dim, p, generated_at)
    summary = _stored(
        spark, st.station_summary(events, coverage, dim, p), f"{out_dir}/station_summary"
    )
    station_docs = _stored(
        spark,
        docs.station_json(st.station_documents(events, coverage, dim, cov.coverage_gaps(obs, p), p)),
        f"{out_dir}/station_documents",
    )
    manifest = _stored(spark, publication.document_manifest(coverage, dim), f"{out_dir}/manifest")
    result = {
        "observations": obs,
        "stations": dim,
        "station_coverage": coverage,
        "record_events": events,
        "record_events_new": new_events,
        "stats": _stored(spark, docs.stats_json(stats_doc), f"{out_dir}/stats"),
        "rankings": _stored(spark, docs.rankings_json(rankings_doc), f"{out_dir}/rankings"),
        "station_summary": summary,
        "station_documents": station_docs,
        "figures": _stored(
            spark, cov.dataset_figures(obs, events, coverage), f"{out_dir}/figures"
        ),
        "manifest": manifest,
    }
    if log is not None:
        result["arrivals"] = log
    if inputs.published is not None:
        result["delta"] = publication.publication_delta(manifest, inputs.published)
    if publish_to is not None:
        publish(result, publish_to)
    return result


def publish(result: dict[str, DataFrame], base: str) -> None:
    """Documents of a run as files below ``base``."""
    named = result["station_documents"].select(
        F.concat(F.lit(publication.STATION_FOLDER), "station_id", F.lit(".json")).alias("path"),
        "text",
    )
    for name in ("stats", "rankings"):
        named = named.unionByName(
            result[name].select(F.lit(f"{name}.json").alias("path"), "text")
        )
    write_files(named, base)
    write_document(docs.summary_array_lines(result["station_summary"]), f"{base}/stations.json", "[]")
    if "delta" in result:
        delete_files(result["delta"], base)


def next_loads(
    obs: DataFrame, ledger: DataFrame, months: DataFrame, p: RunParams
) -> dict[str, DataFrame]:
    """What to land before the next cycle."""
    months_due, chunks, days = planning.ingest_plan(obs, ledger, months, p)
    return {"months": months_due, "chunks": chunks, "days": days}
