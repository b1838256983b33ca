"""Aggregates, leaderboards and documents on small tables that hold the awkward cases."""

import json
from datetime import date

import pytest

import standins
import test_ladder
from highmark.operators import coverage, ladder, rankings, stats
from highmark.operators import rankings as R
from highmark.operators import stations as st
from highmark.params import RunParams
from highmark.plans import daily, documents
from highmark.schemas import STATIONS
from highmark.sources import provinces
from highmark.sources.files import write_document

P = RunParams(as_of=date(2020, 12, 31), active_min_days=1)
EVENTS = "station_id string, kind string, obs_date date, month int, value double, prev_value double, provisional boolean, days_since_prev int"
COVERAGE = "station_id string, first_date date, last_date date, n_days long, n_days_12m long, is_active boolean"


@pytest.fixture(scope="module")
def model(spark):
    d = date
    rows = [
        ("a", "all_max", d(2018, 7, 1), None, 40.0, None, False, None),
        ("a", "all_max", d(2020, 7, 9), None, 41.0, 40.0, False, 739),
        ("a", "month_max", d(2020, 7, 9), 7, 41.0, 39.0, False, 5),
        ("a", "all_max", d(2020, 12, 30), None, 45.0, 41.0, True, 174),
        ("b", "all_min", d(2019, 8, 1), None, 25.0, 20.0, False, 9),
        ("b", "month_min", d(2020, 12, 20), 12, 21.0, 20.5, True, 9),
        ("ghost", "all_max", d(2020, 7, 1), None, 50.0, 49.0, False, 1),
        ("idle", "all_max", d(2020, 7, 1), None, 48.0, 47.0, False, 1),
        ("odd", "month_max", d(2020, 2, 29), 2, 10.0, 9.0, None, 1),
    ]
    events = spark.createDataFrame(rows, EVENTS)
    cov = spark.createDataFrame([(s, d(2018, 1, 1), d(2020, 12, 1), 900, 300, s != "idle") for s in ("a", "b", "ghost", "idle", "odd")], COVERAGE)
    dim = spark.createDataFrame(
        [("a", 'N "1"', "ÁVILA", 5, 1.5, None, None), ("b", None, "BALEARES", None, None, None, None), ("idle", "I", "SORIA", 1, None, None, None), ("odd", "O", "ATLANTIS", 1, None, None, None)],
        STATIONS,
    )
    return events, cov, dim


def test_unknown_province_counts_only_in_total_and_ghosts_vanish(spark, model):
    events, _, dim = model
    groups = stats.group_lookup(dim, provinces.province_aliases(spark))
    cells = {(r.year, r.group_id, r.is_total): r for r in stats.records_by_period_group(events, groups, P, False).collect()}
    total = cells[(2020, None, 1)]
    assert (total.all_max, total.month_max, total.stations_max) == (2, 2, 3)
    unknown = cells[(2020, None, 0)]
    assert (unknown.all_max, unknown.month_max) == (1, 2)
    assert cells[(2020, "soria", 0)].all_max == 1
    assert cells[(2019, "baleares", 0)].stations_min == 1


def test_total_is_sum_of_groups(spark, sf_dir):
    obs = standins.observations(spark, sf_dir, "supplier")
    groups = stats.group_lookup(standins.stations(spark, sf_dir, "supplier"), standins.aliases(spark, sf_dir))
    cells = stats.stations_by_period_group(obs, groups, standins.SUPPLIER, True).collect()
    for year, month in {(r.year, r.month) for r in cells}:
        of_period = [r for r in cells if (r.year, r.month) == (year, month)]
        assert sum(r.n_stations for r in of_period if not r.is_total) == sum(r.n_stations for r in of_period if r.is_total)


def test_all_provinces_in_accent_free_order(spark, model):
    _, _, dim = model
    aliases = provinces.province_aliases(spark)
    obs = spark.createDataFrame([("b", date(2020, 1, 1), 1.0, None, False)], "station_id string, obs_date date, tmax double, tmin double, provisional boolean")
    meta = stats.group_meta(obs, stats.group_lookup(dim, aliases), aliases, provinces.province_names(spark)).orderBy("pos").collect()
    names = [r.name for r in meta]
    assert len(meta) == 53 and names[0] == "Todas las estaciones"
    assert names.index("Asturias") + 1 == names.index("Ávila") == names.index("Badajoz") - 1
    by_id = {r.group_id: r for r in meta}
    assert by_id["baleares"].aliases == ["BALEARES", "ILLES BALEARS"] and by_id["baleares"].n_stations == 1
    assert by_id["total"].n_stations == 1 and by_id["total"].aliases == []


def test_leaderboards(model):
    events, cov, dim = model
    top = rankings.top_alltime(events, cov, dim, "all_max").collect()
    assert [(r.station_id, r.value) for r in top] == [("a", 41.0)]
    recent = {(r.station_id, r.kind): r.is_alltime for r in rankings.recent_records(events, cov, dim).collect()}
    assert recent == {("a", "all_max"): False, ("a", "month_max"): True, ("b", "all_min"): False, ("odd", "month_max"): False}
    assert [r.station_id for r in rankings.longest_standing(events, cov, dim, "all_max").collect()] == ["a"]
    assert [(r.station_id, r.margin) for r in rankings.largest_margins(events, cov, dim).collect()] == [("b", 5.0), ("a", 1.0)]
    # The year of the newest event, which is provisional, still decides.
    assert [(r.station_id, r.n) for r in rankings.most_active(events, cov, dim, P, "year").collect()] == [("a", 2), ("odd", 1)]
    with pytest.raises(ValueError):
        rankings.most_active(events, cov, dim, P, "week")


def test_names_sort_last_when_missing(model):
    events, cov, dim = model
    only = events.filter("station_id in ('b', 'odd')")
    got = rankings.most_active(only, cov, dim, RunParams(as_of=date(2020, 6, 1), active_min_days=1), "12m").collect()
    assert [r.station_id for r in got] == ["odd", "b"]


def test_summary_counts_provisional(model):
    events, cov, dim = model
    rows = {r.station_id: r for r in st.station_summary(events, cov, dim, P).collect()}
    assert set(rows) == {"a", "b", "odd"}
    a = rows["a"]
    assert (a.total_all_max, a.recent15_all_max, a.total_alltime, a.total_monthly) == (2, 1, 2, 1)
    assert (a.last_all_max_date, a.last_all_max_provisional, a.last_month_max_month) == (date(2020, 12, 30), True, 7)
    assert rows["odd"].recent15_month_max == 0


def parse(df):
    return json.loads(df.first().text)


def test_station_document(spark, model):
    events, cov, dim = model
    gaps = spark.createDataFrame([("a", date(2019, 2, 1), date(2019, 2, 9), 9)], "station_id string, gap_from date, gap_to date, n_days int")
    docs = documents.station_json(st.station_documents(events, cov, dim, gaps, P))
    texts = {r.station_id: r.text for r in docs.collect()}
    a = json.loads(texts["a"])
    assert list(a) == [
        "indicativo", "nombre", "provincia", "altitud", "lat", "lon", "datosDesde", "datosHasta", "diasConDatos",
        "totales", "vigentes", "ultimoRecord", "mensuales", "eventos", "sinDatos",
    ]
    assert a["nombre"] == 'N "1"' and a["lon"] is None
    assert a["vigentes"] == {"absolutoMax": {"fecha": "2020-12-30", "valor": 45.0, "provisional": True}, "absolutoMin": None}
    assert a["ultimoRecord"] == {"fecha": "2020-12-30", "tipo": "absoluto-max", "mes": None, "valor": 45.0, "provisional": True}
    assert [m["mes"] for m in a["mensuales"]] == list(range(1, 13))
    assert a["mensuales"][6] == {"mes": 7, "max": {"fecha": "2020-07-09", "valor": 41.0}, "min": None}
    assert [(e["fecha"], e["tipo"], e.get("inicial")) for e in a["eventos"]] == [
        ("2020-12-30", "absoluto-max", None), ("2020-07-09", "absoluto-max", None),
        ("2020-07-09", "mensual-max", None), ("2018-07-01", "absoluto-max", True),
    ]
    assert a["eventos"][-1]["valorAnterior"] is None and a["eventos"][-1]["diasDesdeAnterior"] is None
    assert a["sinDatos"] == [{"desde": "2019-02-01", "hasta": "2019-02-09", "dias": 9}]
    odd = json.loads(texts["odd"])
    assert odd["vigentes"] == {"absolutoMax": None, "absolutoMin": None} and odd["sinDatos"] == []


def test_monthly_record_on_the_alltime_day_is_marked(model):
    events, cov, dim = model
    rows = {(r.station_id, r.month, r.family): r for r in st.current_monthly(events.filter("not provisional or provisional is null")).collect()}
    assert rows[("a", 7, "max")].is_alltime and not rows[("odd", 2, "max")].is_alltime
    assert len(rows) == 24 * len({station for station, _, _ in rows})


def test_station_without_events_gets_an_empty_document(spark, model):
    events, cov, dim = model
    none = events.filter("station_id = 'nobody'")
    gaps = spark.createDataFrame([], "station_id string, gap_from date, gap_to date, n_days int")
    doc = parse(documents.station_json(st.station_documents(none, cov, dim, gaps, P)).filter("station_id = 'a'"))
    assert len(doc["mensuales"]) == 12 and doc["eventos"] == [] and doc["ultimoRecord"] is None
    assert doc["totales"] == {"absolutoMax": 0, "absolutoMin": 0, "mensualMax": 0, "mensualMin": 0}


def test_rankings_document(model):
    events, cov, dim = model
    doc = parse(documents.rankings_json(documents.rankings_document(events, cov, dim, P, "2020-12-31T10:00:00+01:00")))
    assert doc["generadoEn"] == "2020-12-31T10:00:00+01:00"
    assert doc["topAbs"]["max"][0] == {"ind": "a", "nombre": 'N "1"', "prov": "ÁVILA", "alt": 5, "valor": 41.0, "fecha": "2020-07-09"}
    assert doc["topMes"]["max"]["7"][0]["abs"] is True and doc["topMes"]["min"]["1"] == []
    assert "abs" not in doc["topMes"]["max"]["2"][0]
    assert doc["recientes"][0]["ind"] == "a" and doc["recientes"][0]["mes"] == 7
    assert doc["masActivas"]["anio"] == 2020


def test_full_cycle_writes_every_document(spark, tmp_path):
    header = "Estación,Provincia,Temperatura máxima,Temperatura mínima"
    raw_daily = spark.createDataFrame(
        [
            ("a", f"{y}-{m:02d}-{d:02d}", None, "10,0", f"{y - 2000},{m % 10}", None, None) + (None,) * 6
            for y in range(2015, 2021) for m in range(1, 13) for d in (1, 15)
        ],
        "indicativo string, fecha string, tmed string, tmin string, tmax string, horatmin string, horatmax string, prec string, sol string, hrMedia string, velmedia string, presMax string, presMin string",
    )
    inputs = daily.CycleInputs(
        aliases=provinces.province_aliases(spark),
        names=provinces.province_names(spark),
        raw_daily=raw_daily,
        raw_stations=spark.createDataFrame([("a", "Uno", "SORIA", "1000", "405729N", "035959W", None)], "indicativo string, nombre string, provincia string, altitud string, latitud string, longitud string, indsinop string"),
        summary_files=spark.createDataFrame([("f", f"Fecha: 30 diciembre 2020\n{header}\nUno,SORIA,60.5 (15:00),1")], "path string, text string"),
        station_map=spark.createDataFrame([("Uno", "SORIA", "a")], "name string, province string, station_id string"),
        published=spark.createDataFrame([("stations/gone.json",), ("stations/a.json",)], "path string"),
    )
    site = tmp_path / "site"
    (site / "stations").mkdir(parents=True)
    (site / "stations" / "gone.json").write_text("{}")
    result = daily.daily_cycle(spark, inputs, P, str(tmp_path / "v1"), "now", publish_to=f"file://{site}")
    assert json.loads((site / "stations" / "a.json").read_text())["vigentes"]["absolutoMax"] == {"fecha": "2020-12-30", "valor": 60.5, "provisional": True}
    assert not (site / "stations" / "gone.json").exists()
    stats_doc = json.loads((site / "stats.json").read_text())
    assert stats_doc["anios"] == list(range(2015, 2021)) and len(stats_doc["ejeMensual"]) == 72
    assert len(stats_doc["anual"]) == 53 and len(stats_doc["anual"]["soria"]) == 6
    assert stats_doc["anual"]["soria"][0][4] == 1 and stats_doc["mensual"]["madrid"][0] == [0] * 7
    assert json.loads((site / "rankings.json").read_text())["generadoEn"] == "now"
    listed = json.loads((site / "stations.json").read_text())
    assert [s["indicativo"] for s in listed] == ["a"]
    assert not [f for f in site.iterdir() if f.name.startswith(".") and not f.name.endswith(".crc")]
    assert result["record_events_new"].count() == 0
    # The next run starts from the stored version and reports only what is new.
    follow = daily.CycleInputs(
        aliases=inputs.aliases, names=inputs.names, observations=result["observations"], stations=result["stations"],
        previous_events=result["record_events"],
        raw_daily=raw_daily.limit(1).selectExpr("indicativo", "'2020-12-29' as fecha", "tmed", "tmin", "'70' as tmax", *raw_daily.columns[5:]),
    )
    again = daily.daily_cycle(spark, follow, P, str(tmp_path / "v2"))
    assert {(r.kind, r.value) for r in again["record_events_new"].collect()} == {("all_max", 70.0), ("month_max", 70.0)}
    # Without a rewrite the arrivals stay pending and give the same table.
    light = daily.daily_cycle(spark, follow, P, str(tmp_path / "v3"), rewrite=False)
    assert not (tmp_path / "v3" / "observations").exists()
    same = sorted(again["observations"].drop("year").collect(), key=repr)
    assert sorted(light["observations"].collect(), key=repr) == same
    later = daily.CycleInputs(aliases=inputs.aliases, names=inputs.names, observations=result["observations"], pending=light["arrivals"])
    log = daily.arrivals(later, P)
    assert sorted(daily.current_observations(later, log, P).collect(), key=repr) == same


def test_document_of_no_rows_is_an_empty_array(spark, tmp_path):
    lines = spark.createDataFrame([(f"{i}",) for i in range(50)], "text string").orderBy("text")
    write_document(lines.where("text < ''"), f"file://{tmp_path}/stations.json", "[]")
    assert (tmp_path / "stations.json").read_text() == "[]"
    write_document(lines, f"file://{tmp_path}/stations.json", "[]")
    assert (tmp_path / "stations.json").read_text().split() == sorted(str(i) for i in range(50))


def test_coverage_ignores_provisional_but_gaps_do_not(spark):
    rows = [("a", date(2020, 1, 1), 1.0, None, False), ("a", date(2020, 1, 5), 1.0, None, True), ("a", date(2020, 1, 20), None, 1.0, None), ("a", date(2020, 1, 9), None, None, False)]
    obs = spark.createDataFrame(rows, "station_id string, obs_date date, tmax double, tmin double, provisional boolean")
    (c,) = coverage.station_coverage(obs, P).collect()
    assert (c.first_date, c.last_date, c.n_days) == (date(2020, 1, 1), date(2020, 1, 20), 2)
    (gap,) = coverage.coverage_gaps(obs, P).collect()
    assert (gap.gap_from, gap.gap_to, gap.n_days) == (date(2020, 1, 6), date(2020, 1, 19), 14)


def test_gap_across_year_end_and_minimum(spark):
    days = [date(2019, 12, 20), date(2019, 12, 28), date(2020, 1, 5), date(2020, 1, 12)]
    obs = spark.createDataFrame([("a", d, 1.0, None, False) for d in days], "station_id string, obs_date date, tmax double, tmin double, provisional boolean")
    got = sorted((r.gap_from, r.n_days) for r in coverage.coverage_gaps(obs, P).collect())
    assert got == [(date(2019, 12, 21), 7), (date(2019, 12, 29), 7)]


def test_lists_of_ranking_rows_are_those_of_the_ladder(spark, tmp_path):
    """Random ladders with provisional events, at list sizes that bind: every list is the same, from far fewer rows."""
    rows = test_ladder.random_rows(5, stations=14, years=9)
    p = standins.replace(test_ladder.P, as_of=max(r[1] for r in rows), active_min_days=1, warmup_days=30)
    full = ladder.record_events(spark.createDataFrame(rows, test_ladder.SCHEMA), p)
    full.write.parquet(f"{tmp_path}/full")
    full = spark.read.parquet(f"{tmp_path}/full")
    R.ranking_rows(full, p).write.parquet(f"{tmp_path}/few")
    few = spark.read.parquet(f"{tmp_path}/few")
    assert few.count() < full.count() and few.exceptAll(full).count() == 0
    ids = [f"s{k}" for k in range(14)]
    cover = spark.createDataFrame([(i, i != "s3") for i in ids], "station_id string, is_active boolean")
    dim = spark.createDataFrame([(i, f"n{i}", "p", 1) for i in ids], "station_id string, name string, province string, altitude int")
    lists = [
        *[lambda e, k=k: R.top_alltime(e, cover, dim, k, 4) for k in ("all_max", "all_min")],
        *[lambda e, k=k: R.longest_standing(e, cover, dim, k, 4) for k in ("all_max", "all_min")],
        *[lambda e, k=k: R.top_by_month(e, cover, dim, k, 4) for k in ("month_max", "month_min")],
        lambda e: R.recent_records(e, cover, dim), lambda e: R.largest_margins(e, cover, dim),
        *[lambda e, m=m: R.most_active(e, cover, dim, p, m) for m in ("year", "12m")],
    ]
    for of in lists:
        assert sorted(map(repr, of(few).collect())) == sorted(map(repr, of(full).collect()))
    assert R.latest_event_year(few).collect() == R.latest_event_year(full).collect()
