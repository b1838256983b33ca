import json
from datetime import date

import pytest
from pyspark.errors import AnalysisException

from highmark.operators import planning
from highmark.params import RunParams
from highmark.plans.bulk import bulk_load
from highmark.schemas import MONTH_LEDGER, OBSERVATIONS
from highmark.sources import readers, tables

P = RunParams(as_of=date(2024, 6, 30))


def land(base, year, month, name, rows, cut=0):
    folder = base / str(year) / f"{month:02d}"
    folder.mkdir(parents=True, exist_ok=True)
    text = json.dumps(rows)
    (folder / f"{name}.json").write_text(text[: len(text) - cut])


def day(station, fecha, tmax="1,5"):
    return {"indicativo": station, "fecha": fecha, "tmax": tmax, "tmin": "Ip"}


def test_failing_months_stay_pending(spark, tmp_path):
    land(tmp_path, 2020, 1, "a", [day("x", "2020-01-01"), day("x", "2020-01-02")])
    land(tmp_path, 2020, 2, "a", [day("x", "2020-02-01")])
    land(tmp_path, 2020, 2, "b", [day("y", "2020-02-01"), day("y", "2020-02-02")], cut=5)
    land(tmp_path, 2020, 3, "a", [])
    land(tmp_path, 2020, 4, "a", [day("", "2020-04-01"), day("z", "no day"), day("z", "2020-04-03")])
    ledger = spark.createDataFrame([], MONTH_LEDGER)
    got = bulk_load(spark, str(tmp_path), ledger, P, 3)
    assert sorted((r.station_id, r.obs_date.isoformat(), r.tmax, r.provisional, r.seq) for r in got.rows.collect()) == [
        ("x", "2020-01-01", 1.5, False, 3), ("x", "2020-01-02", 1.5, False, 3), ("z", "2020-04-03", 1.5, False, 3)
    ]
    assert sorted((r.year, r.month, r.n_rows) for r in got.ledger.collect()) == [(2020, 1, 2), (2020, 3, 0), (2020, 4, 1)]
    assert sorted((r.indicativo, r.reason) for r in got.rejected.collect()) == [("", "no station"), ("z", "no date")]
    assert [(r.year, r.month) for r in got.failed.collect()] == [(2020, 2)]

    written = spark.createDataFrame([(r.year, r.month, r.n_rows, r.seq) for r in got.ledger.collect()], MONTH_LEDGER)
    land(tmp_path, 2020, 2, "b", [day("y", "2020-02-01"), day("y", "2020-02-02")])
    again = bulk_load(spark, str(tmp_path), written, P, 4)
    assert sorted((r.year, r.month, r.n_rows) for r in again.ledger.collect()) == [(2020, 2, 3)]
    done = planning.month_ledger(written.unionByName(again.ledger))
    last = bulk_load(spark, str(tmp_path), done.selectExpr("year", "month", "n_rows", "5L as seq"), P, 6)
    assert last.rows.count() == last.ledger.count() == last.failed.count() == last.rejected.count() == 0


def test_strict_reading(spark, tmp_path):
    land(tmp_path, 2020, 1, "a", [day("x", "2020-01-01")], cut=4)
    with pytest.raises(Exception):
        readers.read_months(spark, str(tmp_path), [(2020, 1)]).collect()


def test_restore_takes_only_a_missing_path_for_missing(spark, tmp_path):
    assert tables.restore(spark, str(tmp_path / "none"))["observations"].count() == 0
    broken = tmp_path / "broken"
    (broken / "observations").mkdir(parents=True)
    with pytest.raises(AnalysisException):
        tables.restore(spark, str(broken))
    assert tables.load_station_map(spark, str(tmp_path / "nothing")).count() == 0
    assert OBSERVATIONS.names[0] == "station_id"
