"""National daily summaries (text) and the page that names their stations (HTML)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from highmark.functions import cleansing as C
from highmark.params import RunParams

_LINE_END = r"\r\n|[\n\r\u000B\u000C\u001C-\u001E\u0085\u2028\u2029]"
_IN_LINE = r"[^\n\r\u000B\u000C\u001C-\u001E\u0085\u2028\u2029]"
_RECORD_END = r"\r\n|\r"
# A field is quoted (quotes doubled inside, commas and line ends allowed) or plain.
_QUOTED = r'"(?:[^"]|"")*+"[^,\n]*'
_PLAIN = r'(?!")[^,\n]*'
_FIELD = f"({_QUOTED}|{_PLAIN})"
_RECORD = f"((?:{_QUOTED}|{_PLAIN})(?:,(?:{_QUOTED}|{_PLAIN}))*+)\\n"

# Line starts, header cells and preamble length of a summary file.
DATE_LINE, UPDATED_LINE = "Fecha:", "Actualizado:"
PREAMBLE_LINES = 6

# A station row of the page, as a link with the id, then the province cell.
STATION_ROW = (
    r'ultimosdatos\?k=&amp;l=([0-9A-Z]+)&amp;w=2&amp;datos=det&amp;f="[^>]*>'
    r"([^<]+)</a></td>\s*<td[^>]*>([^<]+)</td>"
)
MAP_MIN_ROWS = 500


def _is_name(cell: Column) -> Column:
    return cell.startswith("Estaci")


def _is_province(cell: Column) -> Column:
    return cell == "Provincia"


def _is_max(cell: Column) -> Column:
    return cell.startswith("Temperatura m") & cell.contains("xima")


def _is_min(cell: Column) -> Column:
    return cell.startswith("Temperatura m") & cell.contains("nima") & ~cell.contains("xima")


HEADER_TESTS = {"name": _is_name, "province": _is_province, "tmax": _is_max, "tmin": _is_min}


def _unquoted(field: Column) -> Column:
    inner = F.regexp_extract(field, r'(?s)^"((?:[^"]|"")*+)"', 1)
    rest = F.regexp_replace(field, r'(?s)^"(?:[^"]|"")*+"', "")
    return F.when(
        field.startswith('"'), F.concat(F.regexp_replace(inner, '""', '"'), rest)
    ).otherwise(field)


def _fields(record: Column) -> Column:
    """Fields of a record, still quoted."""
    return F.regexp_extract_all(F.concat(record, F.lit(",")), F.lit(_FIELD + ","), F.lit(1))


def _cells(record: Column) -> Column:
    return F.transform(_fields(record), _unquoted)


def _is_header(record: Column) -> Column:
    """All four columns are there; only records with the right words are taken apart."""
    words = [F.contains(record, F.lit(w)) for w in ("Estaci", "Provincia", "xima", "nima")]
    tests = [F.exists(_cells(record), t) for t in HEADER_TESTS.values()]
    return F.when(_all(words), _all(tests)).otherwise(False)


def _records(text: Column) -> Column:
    """Texts of the records; a quoted field may span lines."""
    lines = F.concat(F.regexp_replace(text, _RECORD_END, "\n"), F.lit("\n"))
    return F.regexp_extract_all(lines, F.lit(_RECORD), F.lit(1))


def _preamble(text: Column) -> Column:
    """The first lines; the rest of the text is not looked at."""
    region = rf"^(?:{_IN_LINE}*+(?:{_LINE_END})){{0,{PREAMBLE_LINES - 1}}}{_IN_LINE}*+"
    return F.split(F.regexp_extract(text, region, 0), _LINE_END)


def _declared_date_text(head: Column) -> Column:
    """ISO text of the date in the preamble: the date line rules, else the first update line."""
    dated = F.filter(head, lambda line: line.startswith(DATE_LINE))
    updated = F.transform(
        F.filter(head, lambda line: line.startswith(UPDATED_LINE)), C.long_date_iso
    )
    return F.when(
        F.size(dated) > 0, C.long_date_iso(F.try_element_at(dated, F.lit(1)))
    ).otherwise(F.try_element_at(F.array_compact(updated), F.lit(1)))


def _last_index(header: Column, test) -> Column:
    return F.array_max(F.transform(header, lambda cell, i: F.when(test(cell), i)))


def parse_daily_summary(files: DataFrame, store: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Rows of summary files: ``obs_date, name, province, tmax, tmin``.

    ``files`` has ``path`` (one row per path), ``text``, and optionally ``requested_date``
    for files that declare no date. A file with an impossible date or without the four
    columns gives nothing. If several files declare one day, the last requested one stands;
    it is found by an aggregation over dates and paths, so no text is ever shuffled.

    With ``store`` (writes a table and reads it back) texts are taken apart once: the rows of all files
    are stored with date and path, and what stands is chosen from these two columns of the stored rows.
    Without it everything is lazy, and the choice takes texts apart a second time.
    """
    requested = (
        F.col("requested_date") if "requested_date" in files.columns else F.lit(None).cast("date")
    )
    parsed = _once(
        files,
        _preamble(F.col("text")).alias("head"),
        requested.alias("requested_date"),
        F.col("path"),
        _records(F.col("text")).alias("records"),
    )
    parsed = parsed.select(_declared_date_text(F.col("head")).alias("declared"), "requested_date", "path", "records")
    header_at = F.array_position(F.transform("records", _is_header), F.lit(True)).cast("int")
    header = _cells(F.try_element_at("records", F.nullif("header_at", F.lit(0))))
    located = _once(parsed, *map(F.col, parsed.columns), header_at.alias("header_at")).select(
        F.when(F.col("declared").isNull(), F.col("requested_date"))
        .otherwise(C.iso_date(F.col("declared")))
        .alias("obs_date"),
        "requested_date",
        "path",
        F.slice("records", F.col("header_at") + 1, F.size("records")).alias("records"),
        *[_last_index(header, test).alias(f"{c}_at") for c, test in HEADER_TESTS.items()],
    )
    places = [F.col(f"{c}_at") for c in HEADER_TESTS]
    last_place = F.greatest(*places)

    # Without a header there are no places, and the test is never true.
    def is_row(record: Column) -> Column:
        return F.size(_fields(record)) > last_place

    def newest(found: DataFrame) -> DataFrame:
        last = F.max(F.struct("requested_date", "path")).alias("last")
        return found.groupBy("obs_date").agg(last).select("obs_date", "last.path")

    def cell(column: str) -> Column:
        return _unquoted(F.get("fields", F.col(f"{column}_at")))

    def rows(files: DataFrame, *keys: str) -> DataFrame:
        split = _once(
            files.select(*keys, *places, F.explode("records").alias("record")),
            *[F.col(k) for k in keys], *[F.col(f"{c}_at") for c in HEADER_TESTS], _fields(F.col("record")).alias("fields"),
        )
        return split.filter(F.size("fields") > last_place).select(
            *keys,
            C.stripped(cell("name")).alias("name"),
            C.stripped(cell("province")).alias("province"),
            C.temperature_cell(cell("tmax")).alias("tmax"),
            C.temperature_cell(cell("tmin")).alias("tmin"),
        )

    if store is not None:
        stored = store(rows(located.filter(F.col("obs_date").isNotNull()), "obs_date", "requested_date", "path"))
        return stored.join(newest(stored), ["obs_date", "path"], "left_semi").drop("requested_date", "path")
    standing = newest(located.filter(F.exists("records", is_row) & F.col("obs_date").isNotNull()))
    return rows(located.join(standing, ["obs_date", "path"], "left_semi"), "obs_date")


def _once(df: DataFrame, *columns: Column) -> DataFrame:
    """Select that later filters cannot make Spark evaluate a second time."""
    return df.select(F.inline(F.array(F.struct(*columns))))


def _all(tests: list[Column]) -> Column:
    result = tests[0]
    for test in tests[1:]:
        result = result & test
    return result


def extract_station_map(pages: DataFrame, min_rows: int = MAP_MIN_ROWS, strict: bool = True) -> DataFrame:
    """``name, province, station_id`` out of the ``html`` of each page.

    A page with fewer than ``min_rows`` matches has changed its layout: it fails the job, or, not
    ``strict``, is left out, so that ``match_with_refresh`` goes on with the stored map.
    Of repeated names the last one on the page, and of pages the last by ``page_id``, counts.
    """

    def group(i: int) -> Column:
        return F.regexp_extract_all("html", F.lit(STATION_ROW), F.lit(i))

    few = F.raise_error(
        F.concat(F.lit("too few station rows on page: "), F.size("found").cast("string"))
    ).cast("boolean")
    page = F.col("page_id") if "page_id" in pages.columns else F.lit(0)
    return (
        pages.select(page.alias("page_id"), "html")
        .withColumn("found", F.arrays_zip(group(1).alias("id"), group(2).alias("name"), group(3).alias("province")))
        .filter(F.when(F.size("found") < min_rows, few if strict else F.lit(False)).otherwise(True))
        .select("page_id", F.posexplode("found").alias("pos", "row"))
        .groupBy(
            C.stripped(F.col("row.name")).alias("name"),
            C.stripped(F.col("row.province")).alias("province"),
        )
        .agg(F.max_by("row.id", F.struct("page_id", "pos")).alias("station_id"))
    )


def match_summary_stations(
    summary: DataFrame, station_map: DataFrame, p: RunParams
) -> tuple[DataFrame, DataFrame]:
    """Summary extremes under their station id, and the names that have none."""
    plausible = F.abs(F.datediff("obs_date", F.lit(p.as_of))) <= p.summary_max_offset_days
    usable = summary.filter(
        plausible & (F.col("tmax").isNotNull() | F.col("tmin").isNotNull())
    )
    keys = ["name", "province"]
    matched = usable.join(station_map, keys).select("station_id", "obs_date", "tmax", "tmin")
    unmatched = usable.select(*keys).distinct().join(station_map, keys, "left_anti")
    return matched, unmatched


def match_with_refresh(
    summary: DataFrame, cached_map: DataFrame, fresh_map: DataFrame, p: RunParams
) -> tuple[DataFrame, DataFrame]:
    """Match with the fresh map if the cached one leaves names over and the fresh one has rows.

    A refreshed map replaces the cached one as a whole. Which one counts is a value that the query
    works out itself: building it runs nothing.
    """
    left_over = match_summary_stations(summary, cached_map, p)[1]
    some = lambda df: F.coalesce(df.agg(F.count(F.lit(1)) > 0).scalar(), F.lit(False))
    refresh = some(left_over) & some(fresh_map)
    columns = ["name", "province", "station_id"]
    chosen = cached_map.select(columns).where(~refresh).unionByName(fresh_map.select(columns).where(refresh))
    return match_summary_stations(summary, chosen, p)
