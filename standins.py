"""The driver's tables in the roles of the domain tables. Every stand-in reads whole tables."""

from __future__ import annotations

from dataclasses import replace
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from highmark.operators.clean import hourly_daily_extremes
from highmark.params import RunParams
from highmark.schemas import MEASURE_COLUMNS, RAW_DAILY, STATIONS

# The day after the last ship date, so no row lies in the future.
AS_OF = date(2001, 11, 5)
# A day within the event table, so that some of its days are live, some late and some early.
LIVE_DAY = date(2024, 1, 27)
FIRST_UNCONFIRMED = date(2001, 10, 22)

# The stand-in series are thinner than daily ones; thresholds that would make every
# active-only result empty are lowered.
PART = RunParams(as_of=AS_OF, active_min_days=3, min_year=1996)
SUPPLIER = replace(PART, active_min_days=30)
KEYS = {"part": "l_partkey", "supplier": "l_suppkey"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _ship_day() -> Column:
    return F.col("l_shipdate").cast("date")


def _thousands() -> Column:
    return F.floor(F.col("l_extendedprice") / 1000).cast("double")


def observations(spark: SparkSession, sf_dir: str, role: str) -> DataFrame:
    """``part`` gives sparse series with long gaps, ``supplier`` dense ones."""
    unconfirmed = F.col("obs_date") >= F.lit(FIRST_UNCONFIRMED)
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(KEYS[role], _ship_day().alias("obs_date"))
        .agg(
            F.max(F.when(F.col("l_returnflag") != "R", _thousands())).alias("tmax"),
            F.min(F.when(F.col("l_linestatus") == "O", _thousands())).alias("tmin"),
            (F.min("l_orderkey") % 997 == 0).alias("stale"),
        )
        .select(
            F.col(KEYS[role]).cast("string").alias("station_id"),
            "obs_date", "tmax", "tmin",
            (unconfirmed | F.col("stale")).alias("provisional"),
        )
    )


def stations(spark: SparkSession, sf_dir: str, role: str) -> DataFrame:
    if role == "part":
        rows = table(spark, sf_dir, "part").select(
            F.col("p_partkey").cast("string").alias("station_id"),
            F.col("p_name").alias("name"),
            F.col("p_brand").alias("province"),
            F.col("p_size").alias("altitude"),
            (F.col("p_size") * 1.5).alias("lat"),
            (-F.col("p_retailprice")).alias("lon"),
        )
    else:
        rows = (
            table(spark, sf_dir, "supplier")
            .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("s_suppkey").cast("string").alias("station_id"),
                F.col("s_name").alias("name"),
                F.col("n_name").alias("province"),
                F.floor("s_acctbal").cast("int").alias("altitude"),
                (F.col("s_nationkey") * 1.5).alias("lat"),
                (-F.col("s_acctbal")).alias("lon"),
            )
        )
    return rows.withColumn("synop_id", F.lit(None).cast("string")).select(STATIONS.names)


def aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two nations per group; those of region 4 are in no group."""
    pair = F.floor(F.col("n_nationkey") / 2).cast("string")
    return (
        table(spark, sf_dir, "nation")
        .filter("n_regionkey <> 4")
        .select(F.col("n_name").alias("alias"), F.concat(F.lit("g"), pair).alias("group_id"))
    )


def group_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names whose order depends on ignoring accents."""
    number = F.floor(F.col("n_nationkey") / 2).cast("int")
    word = F.when(number % 2 == 0, "Área ").otherwise("azul ")
    return table(spark, sf_dir, "nation").select(
        F.concat(F.lit("g"), number.cast("string")).alias("group_id"),
        F.concat(word, number.cast("string")).alias("name"),
    ).distinct()


def raw_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as raw text records, with sentinels, blanks and unreadable values."""
    comma = F.regexp_replace(F.col("l_extendedprice").cast("string"), r"\.", ",")
    number = F.col("l_linenumber")
    day = F.date_format("l_shipdate", "yyyy-MM-dd")
    return table(spark, sf_dir, "lineitem").select(
        F.when(number == 6, "").otherwise(F.col("l_suppkey").cast("string")).alias("indicativo"),
        F.when(number == 7, F.concat(F.lit("x"), day)).otherwise(day).alias("fecha"),
        F.col("l_tax").cast("string").alias("tmed"),
        F.when(number == 2, "1,2,3").otherwise(F.concat(F.lit("-"), comma)).alias("tmin"),
        F.when(number == 2, "Ip").when(number == 3, "  ").when(number == 4, "Acum")
        .otherwise(F.concat(F.lit(" "), comma, F.lit(" "))).alias("tmax"),
        F.when(number == 1, "").otherwise(F.concat(F.col("l_linenumber").cast("string"), F.lit(":00"))).alias("horatmin"),
        F.lit("Varias").alias("horatmax"),
        F.when(number == 5, "NaN").otherwise(F.col("l_quantity").cast("string")).alias("prec"),
        F.when(number == 5, "Varias").otherwise(F.col("l_discount").cast("string")).alias("sol"),
        F.col("l_linenumber").cast("string").alias("hrMedia"),
        F.concat(F.lit("+"), comma).alias("velmedia"),
        F.col("l_returnflag").alias("presMax"),
        F.lit(None).cast("string").alias("presMin"),
    )


def confirmations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records that confirm the provisional days of the supplier series one unit lower."""
    return as_raw(observations(spark, sf_dir, "supplier").filter("provisional"), -1)


def as_raw(days: DataFrame, shift: int = 0) -> DataFrame:
    """Days as raw text records, values moved by ``shift``."""
    def text(value: str) -> Column:
        return F.regexp_replace((F.col(value) + shift).cast("string"), r"\.", ",")

    absent = [c for c in RAW_DAILY.names if c not in ("indicativo", "fecha", "tmax", "tmin")]
    return days.select(
        F.col("station_id").alias("indicativo"),
        F.col("obs_date").cast("string").alias("fecha"),
        text("tmax").alias("tmax"),
        text("tmin").alias("tmin"),
        *[F.lit(None).cast("string").alias(c) for c in absent],
    )


def raw_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as raw station records with ``DDMMSS`` coordinates, every 11th malformed."""
    key = F.col("p_partkey")

    def two(number: Column) -> Column:
        return F.lpad(number.cast("string"), 2, "0")

    digits = F.concat(two(key % 90), two(key % 60), two(key * 7 % 60))
    hemisphere = F.element_at(F.array(*map(F.lit, "NSEW")), (key % 4 + 1).cast("int"))
    coordinate = F.when(key % 11 == 0, F.concat(F.lit("9"), digits)).otherwise(F.concat(digits, hemisphere))
    return table(spark, sf_dir, "part").select(
        key.cast("string").alias("indicativo"),
        F.concat(F.lit("  "), "p_name").alias("nombre"),
        F.when(F.col("p_size") == 1, "  ").otherwise(F.col("p_brand")).alias("provincia"),
        F.when(F.col("p_size") == 2, "2.5").otherwise(F.concat(F.col("p_size").cast("string"), F.lit(" "))).alias("altitud"),
        coordinate.alias("latitud"),
        F.lower(coordinate).alias("longitud"),
        F.col("p_type").alias("indsinop"),
    )


def raw_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event readings; alternately written in UTC and, as the same instant, at +02:00."""
    return as_hourly(table(spark, sf_dir, "events"))


def as_hourly(events: DataFrame) -> DataFrame:
    utc = F.col("ts").cast("timestamp")
    shifted = utc + F.expr("interval 2 hours")
    form = "yyyy-MM-dd'T'HH:mm:ss"
    value = F.col("value").cast("string")
    return events.select(
        F.col("user_id").cast("string").alias("idema"),
        F.when(F.col("event_type") == "error", F.concat(F.date_format(shifted, form), F.lit("+02:00")))
        .otherwise(F.concat(F.date_format(utc, form), F.lit("+0000"))).alias("fint"),
        F.when(F.col("event_type") != "error", value).alias("ta"),
        F.when(F.col("event_type") == "view", F.concat(F.lit("9"), value)).alias("tamax"),
        F.when(F.col("event_type") == "click", F.concat(F.lit("-"), value)).alias("tamin"),
    )


def _with_all_measures(obs: DataFrame) -> DataFrame:
    """Other measures follow the day's maximum, so a wrong source row would show."""
    tie = F.coalesce("tmax", F.lit(0.0))
    extra = {c: tie for c in MEASURE_COLUMNS if c not in ("tmin", "tmax")}
    extra |= {c: F.col("obs_date").cast("string") for c in ("horatmin", "horatmax")}
    return obs.withColumns(extra)


def ingest_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day arrives twice as provisional, and each confirmed day twice as definitive."""
    obs = _with_all_measures(observations(spark, sf_dir, "supplier"))
    # one pass over the days: 1 and 2 are definitive, 3 and 4 provisional
    times = F.when(~F.col("provisional"), F.array(*map(F.lit, (1, 2, 3, 4)))).otherwise(F.array(F.lit(3), F.lit(4)))
    log = obs.withColumn("seq", F.explode(times))
    return log.withColumns(
        {
            "tmax": F.when(F.col("seq") == 1, F.col("tmax") + 50).when(F.col("seq") == 4, F.col("tmax") - 1).otherwise(F.col("tmax")),
            "tmin": F.when(F.col("seq") == 4, F.col("tmin") - 1).otherwise(F.col("tmin")),
            "provisional": F.when(F.col("seq") >= 3, True),
            "seq": F.col("seq").cast("bigint"),
        }
    )


def incoming_provisional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extremes of the day after each ship date: some hit stored days, some are new."""
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_suppkey").cast("string").alias("station_id"), F.date_add(_ship_day(), 1).alias("obs_date"))
        .agg(F.max("l_quantity").alias("tmax"), F.min("l_quantity").alias("tmin"))
    )


MONTH_WORDS = [
    "enero", "febrero", "marzo", "abril", "mayo", "junio",
    "julio", "agosto", "septiembre", "octubre", "noviembre", "diciembre",
]


def summary_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station names as summaries spell them: with a comma and quotes."""
    named = stations(spark, sf_dir, "supplier")
    return named.select(
        "station_id", F.concat(F.lit("El \"Alto\", "), "name").alias("name"), "province"
    )


def summary_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One summary text per ship date, out of the supplier series."""
    def cell(value: str) -> Column:
        return F.coalesce(F.concat(F.col(value).cast("string"), F.lit(" (16:40)")), F.lit(""))

    quoted = F.concat(F.lit('"'), F.regexp_replace("name", '"', '""'), F.lit('"'))
    lines = (
        observations(spark, sf_dir, "supplier")
        .join(summary_names(spark, sf_dir), "station_id")
        .select("obs_date", F.concat_ws(",", quoted, "province", cell("tmax"), F.lit("12 km/h"), cell("tmin")).alias("line"))
    )
    word = F.element_at(F.array(*map(F.lit, MONTH_WORDS)), F.month("obs_date"))
    declared = F.concat_ws(
        " ", F.lit("Fecha: lunes,"), F.dayofmonth("obs_date").cast("string"), word, F.year("obs_date").cast("string")
    )
    header = F.lit("Estación,Provincia,Temperatura máxima (ºC),Racha (km/h),Temperatura mínima (ºC)")
    preamble = F.lit("Resumen nacional\r\nActualizado: martes, 1 enero 2030")
    body = F.concat_ws("\r\n", preamble, declared, F.lit(""), header, F.array_join("lines", "\r\n"))
    return (
        lines.groupBy("obs_date")
        .agg(F.sort_array(F.collect_list("line")).alias("lines"))
        .select(F.date_format("obs_date", "yyyyMMdd").alias("path"), body.alias("text"))
        # as files would lie: adaptive execution must not gather the small texts into one task
        .repartition(spark.sparkContext.defaultParallelism)
    )


def station_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The driver's pages as they are, plus one page per nation that lists its suppliers twice."""
    def row(station: Column) -> Column:
        return F.concat(
            F.lit('<tr><td><a href="ultimosdatos?k=&amp;l='), station,
            F.lit('&amp;w=2&amp;datos=det&amp;f="temperatura" title="x"> '), F.col("name"),
            F.lit(' </a></td>\n <td class="p">'), F.col("province"), F.lit("</td></tr>"),
        )

    named = stations(spark, sf_dir, "supplier")
    listed = (
        named.groupBy("province")
        .agg(
            F.array_join(F.sort_array(F.collect_list(row(F.concat(F.lit("OLD"), "station_id")))), "").alias("old"),
            F.array_join(F.sort_array(F.collect_list(row(F.concat(F.lit("X"), "station_id")))), "").alias("new"),
        )
        .select(F.lit(-1).cast("bigint").alias("page_id"), F.concat("old", "new").alias("html"))
    )
    return table(spark, sf_dir, "pages").select("page_id", "html").unionByName(listed)


def month_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months that ended before the stored part of the history stand-in count as loaded."""
    day = _ship_day()
    return (
        table(spark, sf_dir, "lineitem")
        .filter(day < F.lit(HISTORY_CUT))
        .groupBy(F.year(day).alias("year"), F.month(day).alias("month"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .withColumn("seq", F.lit(1).cast("bigint"))
    )


def months(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = _ship_day()
    return table(spark, sf_dir, "lineitem").select(F.year(day).alias("year"), F.month(day).alias("month")).distinct()


HISTORY = replace(PART, min_backfill_year=1999, history_floor_year=1994, empty_stop=2)
HISTORY_CUT = date(1999, 1, 1)


def history_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Small parts were started; of these the even sizes were finished."""
    part = table(spark, sf_dir, "part").filter("p_size <= 30").select(
        F.col("p_partkey").cast("string").alias("station_id"),
        F.when(F.col("p_size") % 2 == 0, "finished").otherwise("started").alias("event"),
        F.lit(date(1998, 1, 1)).alias("earliest"),
        F.col("p_size").cast("bigint").alias("n_rows"),
        F.lit(2).cast("bigint").alias("seq"),
    )
    started = part.withColumns(
        {"event": F.lit("started"), "earliest": F.lit(None).cast("date"), "n_rows": F.lit(None).cast("bigint"), "seq": F.lit(1).cast("bigint")}
    )
    return part.unionByName(started)


# Days that the versioned store is taken to, run by run. The last one is the day of all other queries.
RUN_DAYS = (date(2001, 5, 9), date(2001, 8, 20), AS_OF)
CORRECTED_YEAR = 1998


def run_arrivals(spark: SparkSession, sf_dir: str, run: int) -> DataFrame:
    """Numbered arrivals of the supplier series in one of the runs of ``RUN_DAYS``.

    The first brings all days so far: those of its last ten days as provisional and one unit lower, and
    for every seventh supplier days of ``CORRECTED_YEAR`` that the second corrects. Each later one brings
    the days since ten days before the last.
    """
    obs = observations(spark, sf_dir, "supplier")
    until = F.lit(RUN_DAYS[run])
    rows = obs.filter(F.col("obs_date") <= until)
    late = F.col("obs_date") > F.date_sub(until, 10)
    wrong = (F.col("station_id").cast("int") % 7 == 0) & (F.year("obs_date") == CORRECTED_YEAR) & (F.dayofmonth("obs_date") == 15)
    if run == 0:
        rows = rows.withColumn("tmax", F.when(wrong, F.col("tmax") + 50).otherwise(F.col("tmax")))
    else:
        since = F.col("obs_date") > F.date_sub(F.lit(RUN_DAYS[run - 1]), 10)
        rows = rows.filter((since | wrong) if run == 1 else since)
    if run < len(RUN_DAYS) - 1:
        rows = rows.withColumns(
            {c: F.when(late, F.col(c) - 1).otherwise(F.col(c)) for c in ("tmax", "tmin")} | {"provisional": F.col("provisional") | late}
        )
    return rows.withColumn("seq", F.lit(run).cast("bigint"))


def as_pages(raw: DataFrame, *keys: str) -> DataFrame:
    """One row per page (``keys``) with the JSON array of its raw records."""
    record = F.to_json(F.struct(*[c for c in raw.columns if c not in keys]))
    return raw.groupBy(*keys).agg(F.concat(F.lit("["), F.array_join(F.sort_array(F.collect_list(record)), ","), F.lit("]")).alias("text"))


UNREADABLE = '[{"indicativo": "1", "fec'
# Days up to which the incremental stand-in is stored, and the plan for the days after them.
STORED_UNTIL = date(2001, 8, 31)
CHUNKS = replace(SUPPLIER, chunk_days=10)


def chunk_pages(spark: SparkSession, sf_dir: str, chunks: DataFrame) -> DataFrame:
    """``path, text`` of the pages of ``chunks``: the third is unreadable, the fifth empty, the sixth missing."""
    days = observations(spark, sf_dir, "supplier").withColumn("provisional", F.lit(False))
    number = F.row_number().over(Window.orderBy("chunk_start"))
    at = F.expr("obs_date BETWEEN chunk_start AND chunk_end")
    # the chunks are a few rows
    cut = days.join(F.broadcast(chunks), at)
    raw = as_raw(cut).withColumn("obs_date", F.col("fecha").cast("date")).join(F.broadcast(chunks), at).drop("obs_date", "chunk_end")
    pages = chunks.select("chunk_start", number.alias("number")).join(as_pages(raw, "chunk_start"), "chunk_start", "left")
    text = F.when(F.col("number") == 3, UNREADABLE).when(F.col("number") == 5, "[]").otherwise(F.coalesce("text", F.lit("[]")))
    return pages.filter("number <> 6").select(F.concat(F.col("chunk_start").cast("string"), F.lit(".json")).alias("path"), text.alias("text"))


def history_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``path, text`` of every supplier's half-years: some empty, some unreadable; those of every tenth not landed before 1996-07."""
    key, start = F.col("s_suppkey"), F.col("win_start")
    half = F.year("win_start") * 2 + F.when(F.month("win_start") > 6, 1).otherwise(0)
    windows = table(spark, sf_dir, "supplier").select(
        key, F.explode(F.expr("sequence(DATE '1994-01-01', DATE '2001-07-01', INTERVAL 6 MONTH)")).alias("win_start")
    ).filter(~((key % 10 == 9) & (start < F.lit(date(1996, 7, 1)))))
    day = F.col("fecha").cast("date")
    archive = as_raw(observations(spark, sf_dir, "supplier").filter(F.col("obs_date") < F.lit(HISTORY_CUT)))
    first_month = F.when(F.month(day) <= 6, 1).otherwise(7)
    archive = archive.withColumns({"s_suppkey": F.col("indicativo").cast("long"), "win_start": F.make_date(F.year(day), first_month, F.lit(1))})
    pages = windows.join(as_pages(archive, "s_suppkey", "win_start"), ["s_suppkey", "win_start"], "left")
    text = (
        F.when((key + half) % 11 == 3, UNREADABLE)
        .when((key * 7 + half) % 5 <= 1, "[]")
        .otherwise(F.coalesce("text", F.lit("[]")))
    )
    path = F.concat(F.lit("station="), key.cast("string"), F.lit("/"), start.cast("string"), F.lit(".json"))
    return pages.select(path.alias("path"), text.alias("text"))


def supplier_history_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of four suppliers one is finished, one started."""
    rest = F.col("s_suppkey") % 4
    return table(spark, sf_dir, "supplier").filter(rest <= 1).select(
        F.col("s_suppkey").cast("string").alias("station_id"),
        F.when(rest == 0, "finished").otherwise("started").alias("event"),
        F.lit(None).cast("date").alias("earliest"), F.lit(None).cast("bigint").alias("n_rows"), F.lit(1).cast("bigint").alias("seq"),
    )


BROKEN_MONTH = (2000, 5)
PAGE_RECORDS = 20_000


def month_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``path, text`` of the order lines' days as ``YYYY/MM/DD-n.json``; files of one month cannot be read to their end.

    A file has ``PAGE_RECORDS`` records at most, however many a day has.
    """
    day = F.right("fecha", F.lit(10)).cast("date")
    raw = raw_daily(spark, sf_dir)
    dated = raw.withColumns({"year": F.year(day), "month": F.month(day), "day": F.dayofmonth(day)})
    in_order = Window.partitionBy("year", "month", "day").orderBy(*raw.columns)
    dated = dated.withColumn("n", F.floor((F.row_number().over(in_order) - 1) / PAGE_RECORDS).cast("int"))
    broken = (F.col("year") == BROKEN_MONTH[0]) & (F.col("month") == BROKEN_MONTH[1])
    path = F.format_string("%d/%02d/%02d-%d.json", "year", "month", "day", "n")
    text = F.when(broken, F.left("text", F.length("text") - 9)).otherwise(F.col("text"))
    return as_pages(dated, "year", "month", "day", "n").select(path.alias("path"), text.alias("text"))


def hourly_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``path, text`` of the readings, one file a day."""
    raw = raw_hourly(spark, sf_dir).withColumn("day", F.left("fint", F.lit(10)))
    return as_pages(raw, "day").select(F.concat("day", F.lit(".json")).alias("path"), "text")


def station_pages_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``path, text`` of the raw stations, one file a province."""
    raw = raw_stations(spark, sf_dir).withColumn("file", F.concat(F.lit("p"), F.regexp_replace("provincia", "[^A-Za-z0-9]", "")))
    return as_pages(raw, "file").select(F.concat("file", F.lit(".json")).alias("path"), "text")


def station_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as they arrive: all of them twice, the later time without the altitude of every fifth."""
    first = stations(spark, sf_dir, "supplier").withColumns({"name": F.concat(F.lit("old "), "name"), "seq": F.lit(1)})
    fifth = F.col("station_id").cast("int") % 5 == 0
    return first.unionByName(
        stations(spark, sf_dir, "supplier").withColumns({"altitude": F.when(~fifth, F.col("altitude")), "seq": F.lit(2)})
    )


def hourly_confirmations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw daily records, one unit lower, for the days of every third user."""
    days = hourly_daily_extremes(raw_hourly(spark, sf_dir), PART.local_tz)
    return as_raw(days.filter(F.col("station_id").cast("int") % 3 == 0), -1)
