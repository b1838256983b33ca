"""Physical plans: shuffles, no Python rows, no products."""

import re

import pytest

import catalog
import standins
from highmark.operators import ladder

NOT_EAGER = [n for n in catalog.queries() if not n.startswith(("versioned_", "history_load_", "chunk_load_", "bulk_load_", "landed_")) and n not in ("daily_cycle", "daily_cycle_new_events", "daily_cycle_pending", "published_files", "restore_into", "stream_definitive_supersedes", "parse_daily_summary", "stream_daily_extremes", "live_daily_extremes", "snapshot_restore", "snapshot_tables", "stats_document", "rankings_document", "rankings_document_reduced", "station_documents")]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("obs") / "obs")
    standins.observations(spark, sf_dir, "part").write.parquet(path)
    return spark.read.parquet(path)


def test_ladder_shuffles_blocks_then_survivors(stored):
    text = plan(ladder.record_events(stored, standins.PART))
    assert re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text).__len__() == 2
    assert len(re.findall(r"Exchange hashpartitioning\(station_id#\d+, month#\d+, year_run#\d+", text)) == 1


def test_scan_reads_only_needed_columns(stored):
    text = plan(ladder.coverage_segments(stored, standins.PART))
    assert "provisional" not in text.split("ReadSchema")[1]
    assert "PushedFilters" in text


@pytest.mark.parametrize("name", NOT_EAGER)
def test_no_python_rows_and_no_products(spark, sf_dir, name):
    text = plan(catalog.queries()[name](spark, sf_dir))
    assert "EvalPython" not in text and "InPandas" not in text
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


def test_station_documents_reduce_the_ladder_once(spark, stored, tmp_path):
    """One shuffle each for ladder, gaps, dimension and coverage, and one scan of the ladder."""
    from highmark.operators import coverage, stations

    p = standins.PART
    tables = {
        "events": ladder.record_events(stored, p), "coverage": coverage.station_coverage(stored, p),
        "gaps": coverage.coverage_gaps(stored, p), "dim": spark.createDataFrame([], standins.STATIONS),
    }
    for name, table in tables.items():
        table.write.parquet(f"{tmp_path}/{name}")
        tables[name] = spark.read.parquet(f"{tmp_path}/{name}")
    text = plan(stations.station_documents(tables["events"], tables["coverage"], tables["dim"], tables["gaps"], p))
    assert len(re.findall(r"Exchange hashpartitioning", text)) <= 4
    assert len(re.findall(r"ReadSchema: struct<[^>]*prev_value", text)) == 1
