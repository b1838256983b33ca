from datetime import date

import pytest
from pyspark.sql import functions as F

from highmark.functions import cleansing as C
from highmark.operators import clean
from highmark.params import RunParams
from highmark.schemas import RAW_DAILY, RAW_HOURLY, RAW_STATION
from highmark.sources import provinces, summaries


def apply(spark, function, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r[1] for r in df.select("i", function(F.col("x"))).orderBy("i").collect()]


def test_numbers(spark):
    texts = ["12,3", " -4.5 ", "+7", "Ip", "Acum", "Varias", "", "  ", None, "NaN", "inf", "1d", "0x1p3", "1,2,3", "5.", ".5", "1e2", "\t8 "]
    assert apply(spark, C.decimal_text, texts) == [
        12.3, -4.5, 7.0, None, None, None, None, None, None, None, None, None, None, None, 5.0, 0.5, 100.0, 8.0,
    ]
    assert apply(spark, C.integer_text, ["12", " 7 ", "2.5", "x", "", None, "99999999999"]) == [12, 7, None, None, None, None, None]


def test_coordinates(spark):
    got = apply(spark, C.coordinate_text, ["405729N", "035959W", " 003030S ", "4057N", "405729X", "405729n", None])
    assert got[0] == pytest.approx(40 + 57 / 60 + 29 / 3600)
    assert got[1] == pytest.approx(-(3 + 59 / 60 + 59 / 3600))
    assert got[2] == pytest.approx(-(30 / 60 + 30 / 3600))
    assert got[3:] == [None] * 4


def test_cells_and_dates(spark):
    assert apply(spark, C.temperature_cell, ["36.8 (16:40)", "-2,5 (07:00)", "(16:40)", "", None]) == [36.8, -2.5, None, None, None]
    assert apply(spark, C.long_date_iso, ["Fecha: sábado, 11 julio 2026", "3 ENERO 2020", "1 foo 2020", "nada", None]) == [
        "2026-07-11", "2020-01-03", None, None, None,
    ]
    assert apply(spark, C.accent_free_key, ["Ávila", "A Coruña", "Åse ÝŠŽ", "ǅ½ øß"]) == ["avila", "a coruna", "ase ysz", " "]


def test_daily_rows_without_key_are_dropped(spark):
    raw = [("a", "2020-02-29"), ("a", "2021-02-29"), ("", "2020-01-01"), (None, "2020-01-01"), ("b", None)]
    df = spark.createDataFrame([(s, d, *[None] * 11) for s, d in raw], RAW_DAILY)
    assert [(r.station_id, r.obs_date) for r in clean.clean_daily(df).collect()] == [("a", date(2020, 2, 29))]


def test_stations(spark):
    df = spark.createDataFrame([("a", " N ", "  ", "12", "405729N", None, ""), (None, "x", None, None, None, None, None)], RAW_STATION)
    (row,) = clean.clean_stations(df).collect()
    assert (row.name, row.province, row.altitude, row.lon, row.synop_id) == ("N", None, 12, None, None)


def test_local_days_over_clock_changes(spark):
    # Madrid: 23 hours on 2024-03-31, 25 hours on 2024-10-27.
    rows = [
        ("a", "2024-03-30T22:59:59+0000", "1", None, None),
        ("a", "2024-03-30T23:00:00+0000", "2", "9", None),
        ("a", "2024-03-31T21:59:59+0000", "3", None, "-9"),
        ("a", "2024-03-31T22:00:00+0000", "4", None, None),
        ("a", "2024-10-26T22:00:00+0000", "5", None, None),
        ("a", "2024-10-27T22:59:59+0000", "6", None, None),
        ("a", "2024-10-28T01:00:00+02:00", "7", None, None),
        ("a", "2024-10-28T01:00:00", "70", None, None),
        ("a", "2024-12-01T01:00:00+0000", None, None, None),
        ("", "2024-10-28T01:00:00+0000", "8", None, None),
        ("a", None, "8", None, None),
    ]
    df = spark.createDataFrame(rows, RAW_HOURLY)
    got = {r.obs_date.isoformat(): (r.tmax, r.tmin) for r in clean.hourly_daily_extremes(df, "Europe/Madrid").collect()}
    assert got == {
        "2024-03-30": (1.0, 1.0),
        "2024-03-31": (9.0, -9.0),
        "2024-04-01": (4.0, 4.0),
        "2024-10-27": (6.0, 5.0),
        "2024-10-28": (7.0, 7.0),
    }


HEADER = "Estación,Provincia,Temperatura máxima (ºC),Otra,Temperatura mínima (ºC)"


def summary(spark, *texts, requested=None):
    df = spark.createDataFrame([(str(i), t, requested) for i, t in enumerate(texts)], "path string, text string, requested_date date")
    return sorted(tuple(r) for r in summaries.parse_daily_summary(df).collect())


def test_summary_text(spark):
    text = "\r\n".join(
        ["Título", "Actualizado: lunes, 1 enero 2020", "Fecha: martes, 2 enero 2020", "", HEADER,
         '"A, ""b"" c",Soria,30.1 (1:00),x,-1.5 (2:00)', "corta,Soria", "D , Ávila ,,,2", '"dos\nlíneas",Soria,1,2,3']
    )
    assert summary(spark, text) == [
        (date(2020, 1, 2), 'A, "b" c', "Soria", 30.1, -1.5),
        (date(2020, 1, 2), "D", "Ávila", None, 2.0),
        (date(2020, 1, 2), "dos\nlíneas", "Soria", 1.0, 3.0),
    ]


def test_summary_dates(spark):
    body = f"\n{HEADER}\nA,B,1,x,0"
    asked = date(2020, 5, 5)
    assert summary(spark, "Actualizado: 3 mayo 2020" + body)[0][0] == date(2020, 5, 3)
    assert summary(spark, "sin fecha" + body, requested=asked)[0][0] == asked
    assert summary(spark, "Fecha: 1 foo 2020" + body, requested=asked)[0][0] == asked
    assert summary(spark, "Fecha: 31 febrero 2020" + body, requested=asked) == []
    assert summary(spark, "sin fecha" + body) == []
    assert summary(spark, "\n" * 6 + "Fecha: 1 mayo 2020" + body) == []
    assert summary(spark, "Fecha: 1 mayo 2020\nEstación,Provincia,x\nA,B,1") == []


def test_last_file_of_a_day_stands(spark):
    first = f"Fecha: 1 mayo 2020\n{HEADER}\nA,B,1,x,0"
    second = f"Fecha: 1 mayo 2020\n{HEADER}\nA,B,2,x,0\nC,B,3,x,0"
    empty = f"Fecha: 1 mayo 2020\n{HEADER}\n"
    assert [r[3] for r in summary(spark, first, second, empty)] == [2.0, 3.0]


def page(*rows):
    link = '<a href="ultimosdatos?k=&amp;l={}&amp;w=2&amp;datos=det&amp;f="t">{}</a></td>\n<td>{}</td>'
    return "<html>" + "".join(link.format(*r) for r in rows) + "</html>"


def test_station_map(spark):
    df = spark.createDataFrame([(page(("1A", " X ", "P"), ("2B", "Y", "P"), ("3C", "X", " P ")),)], "html string")
    got = {(r.name, r.province): r.station_id for r in summaries.extract_station_map(df, 3).collect()}
    assert got == {("X", "P"): "3C", ("Y", "P"): "2B"}
    with pytest.raises(Exception, match="too few station rows"):
        summaries.extract_station_map(df, 4).collect()


def test_match_and_refresh(spark):
    p = RunParams(as_of=date(2020, 1, 10))
    df = spark.createDataFrame(
        [(date(2020, 1, 2), "X", "P", 1.0, None), (date(2020, 1, 1), "X", "P", 1.0, None), (date(2020, 1, 9), "Y", "P", 1.0, 2.0), (date(2020, 1, 9), "Z", "P", None, None)],
        "obs_date date, name string, province string, tmax double, tmin double",
    )
    schema = "name string, province string, station_id string"
    old = spark.createDataFrame([("X", "P", "1")], schema)
    matched, unmatched = summaries.match_summary_stations(df, old, p)
    assert [(r.station_id, r.obs_date.day) for r in matched.collect()] == [("1", 2)]
    assert [tuple(r) for r in unmatched.collect()] == [("Y", "P")]
    new = spark.createDataFrame([("X", "P", "1"), ("Y", "P", "2")], schema)
    matched, unmatched = summaries.match_with_refresh(df, old, new, p)
    assert matched.count() == 2 and unmatched.isEmpty()


def test_province_tables():
    pairs = provinces.alias_pairs()
    assert len(pairs) == 54 and len(provinces.GROUP_NAMES) == 52
    assert {g for _, g in pairs} == set(provinces.GROUP_NAMES)
    named = dict(pairs)
    assert named["BALEARES"] == named["ILLES BALEARS"]
    assert named["STA. CRUZ DE TENERIFE"] == named["SANTA CRUZ DE TENERIFE"]
    assert "A CORUNA" not in named and "LA RIOJA" in named
