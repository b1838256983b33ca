"""Declared schemas, record kinds and the raw field names they come from."""

from __future__ import annotations

from pyspark.sql import types as T

ALL_MAX, ALL_MIN = "all_max", "all_min"
MONTH_MAX, MONTH_MIN = "month_max", "month_min"
ALL_TIME_KINDS = (ALL_MAX, ALL_MIN)
MONTHLY_KINDS = (MONTH_MAX, MONTH_MIN)
KINDS = ALL_TIME_KINDS + MONTHLY_KINDS

# Column <- key of the raw daily record.
DAILY_TEXT_FIELDS = {
    "station_id": "indicativo",
    "obs_date": "fecha",
    "horatmin": "horatmin",
    "horatmax": "horatmax",
}
DAILY_NUMBER_FIELDS = {
    "tmed": "tmed",
    "tmin": "tmin",
    "tmax": "tmax",
    "prec": "prec",
    "sol": "sol",
    "hr_media": "hrMedia",
    "vel_media": "velmedia",
    "pres_max": "presMax",
    "pres_min": "presMin",
}


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


RAW_DAILY = _strings(
    "indicativo", "fecha", "tmed", "tmin", "tmax", "horatmin", "horatmax",
    "prec", "sol", "hrMedia", "velmedia", "presMax", "presMin",
)
RAW_STATION = _strings(
    "indicativo", "nombre", "provincia", "altitud", "latitud", "longitud", "indsinop"
)
RAW_HOURLY = _strings("idema", "fint", "ta", "tamax", "tamin")

OBSERVATIONS = T.StructType(
    [
        T.StructField("station_id", T.StringType()),
        T.StructField("obs_date", T.DateType()),
        T.StructField("tmed", T.DoubleType()),
        T.StructField("tmin", T.DoubleType()),
        T.StructField("tmax", T.DoubleType()),
        T.StructField("horatmin", T.StringType()),
        T.StructField("horatmax", T.StringType()),
        T.StructField("prec", T.DoubleType()),
        T.StructField("sol", T.DoubleType()),
        T.StructField("hr_media", T.DoubleType()),
        T.StructField("vel_media", T.DoubleType()),
        T.StructField("pres_max", T.DoubleType()),
        T.StructField("pres_min", T.DoubleType()),
        T.StructField("provisional", T.BooleanType()),
    ]
)
CLEAN_DAILY_COLUMNS = [f.name for f in OBSERVATIONS if f.name != "provisional"]
MEASURE_COLUMNS = [c for c in CLEAN_DAILY_COLUMNS if c not in ("station_id", "obs_date")]

STATIONS = T.StructType(
    [
        T.StructField("station_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("province", T.StringType()),
        T.StructField("altitude", T.IntegerType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("synop_id", T.StringType()),
    ]
)

STATION_MAP = _strings("name", "province", "station_id")

MONTH_LEDGER = T.StructType(
    [
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("seq", T.LongType()),
    ]
)
CHUNK_LEDGER = T.StructType(
    [
        T.StructField("chunk_start", T.DateType()),
        T.StructField("chunk_end", T.DateType()),
        T.StructField("outcome", T.StringType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("seq", T.LongType()),
    ]
)
HISTORY_LEDGER = T.StructType(
    [
        T.StructField("station_id", T.StringType()),
        T.StructField("event", T.StringType()),
        T.StructField("earliest", T.DateType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("seq", T.LongType()),
    ]
)

EVENT_COLUMNS = [
    "station_id", "kind", "obs_date", "month", "value", "prev_value",
    "provisional", "days_since_prev",
]
