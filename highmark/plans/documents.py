"""Nested documents of a run and their JSON text.

Leaderboards are top-N lists and the grid is groups by calendar, so those two documents
are one bounded row each. Station documents stay one row per station.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from highmark.functions import json_text as J
from highmark.functions.predicates import margin
from highmark.operators import rankings as R
from highmark.operators import stats as S
from highmark.params import RunParams
from highmark.schemas import ALL_MAX, ALL_MIN, KINDS, MONTH_MAX, MONTH_MIN

# Published name and document key of each kind.
KIND_NAMES = {
    ALL_MAX: "absoluto-max",
    ALL_MIN: "absoluto-min",
    MONTH_MAX: "mensual-max",
    MONTH_MIN: "mensual-min",
}
KIND_KEYS = {
    ALL_MAX: "absolutoMax",
    ALL_MIN: "absolutoMin",
    MONTH_MAX: "mensualMax",
    MONTH_MIN: "mensualMin",
}


# ---- nested rows ----------------------------------------------------------------------


Store = Callable[[str, DataFrame], DataFrame]


def stats_tables(
    obs: DataFrame,
    events: DataFrame,
    groups: DataFrame,
    aliases: DataFrame,
    names: DataFrame,
    p: RunParams,
    store: Store = lambda name, table: table,
) -> dict[str, DataFrame]:
    """Groups and cells of the aggregates document.

    ``store`` may write a table and read it back, so that the document, which looks at
    each table several times, does not compute it as often.
    """
    months = store("definitive_months", S.definitive_months(obs))
    tables = {"groups": store("groups", S.group_meta(obs, groups, aliases, names, months))}
    for monthly, word in ((False, "yearly"), (True, "monthly")):
        records = S.records_by_period_group(events, groups, p, monthly)
        stations = S.stations_by_period_group(obs, groups, p, monthly, months)
        tables[f"{word}_records"] = store(f"{word}_records", records)
        tables[f"{word}_stations"] = store(f"{word}_stations", stations)
    return tables


def stats_document(tables: dict[str, DataFrame], generated_at: str | None = None) -> DataFrame:
    """One row: axes, groups, and the yearly and monthly grids in group order."""
    meta = tables["groups"]
    known = meta.select("group_id")
    years = S.year_axis(
        _of_groups(tables["yearly_records"], known), _of_groups(tables["yearly_stations"], known)
    )

    def grid(word: str) -> Column:
        monthly = word == "monthly"
        dense = S.dense_stats(
            tables[f"{word}_records"], tables[f"{word}_stations"], known, monthly, years
        )
        period = F.struct(*S.period_columns(monthly), S.as_row().alias("row"))
        rows = dense.groupBy("group_id").agg(F.sort_array(F.collect_list(period)).alias("rows"))
        placed = meta.join(rows, "group_id", "left").select(
            "pos",
            "group_id",
            F.coalesce(F.transform("rows", lambda r: r["row"]), F.array()).alias("rows"),
        )
        return placed.agg(F.sort_array(F.collect_list(F.struct("pos", "group_id", "rows")))).scalar()

    entries = F.struct("pos", "group_id", "name", "n_stations", "aliases")
    return (
        meta.sparkSession.range(1)
        .select(
            F.lit(generated_at).cast("string").alias("generated_at"),
            years.scalar().alias("years"),
            meta.agg(F.sort_array(F.collect_list(entries))).scalar().alias("groups"),
            grid("yearly").alias("yearly"),
            grid("monthly").alias("monthly"),
        )
        .select(
            "generated_at",
            F.array_min("years").alias("year_min"),
            F.array_max("years").alias("year_max"),
            F.array(*[F.lit(f) for f in S.ROW_FIELDS]).alias("row_fields"),
            "years",
            F.flatten(
                F.transform(
                    "years",
                    lambda y: F.transform(
                        F.sequence(F.lit(1), F.lit(12)), lambda m: F.array(y, m)
                    ),
                )
            ).alias("month_axis"),
            "groups", "yearly", "monthly",
        )
    )


def _of_groups(cells: DataFrame, known: DataFrame) -> DataFrame:
    """Cells of the total and of known groups; an unknown group adds no year to the axis."""
    total = cells.filter("is_total = 1")
    return total.unionByName(cells.filter("is_total = 0").join(known, "group_id", "left_semi"))


def _listed(df: DataFrame, *order: Column) -> Column:
    """A bounded list as a subquery value, in the given order."""
    row = F.struct(F.struct(*order).alias("order"), F.struct(*df.columns).alias("row"))
    rows = df.agg(F.sort_array(F.collect_list(row)).alias("rows"))
    return rows.select(F.transform("rows", lambda r: r["row"])).scalar()


def rankings_document(
    events: DataFrame,
    coverage: DataFrame,
    stations: DataFrame,
    p: RunParams,
    generated_at: str | None = None,
    store: Callable[[str, DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """One row holding every leaderboard.

    Each list reads a few columns of the ladder, so that should be stored. With ``store`` the ladder is read
    once and cut to ``ranking_rows``, which are kept for all lists; that pays where stations have long
    ladders, not where most of their events can be in a list.
    """
    if store is not None:
        events = store("ranking_rows", R.ranking_rows(events, p))
    tables = (events, coverage, stations)
    day, value = F.unix_date("obs_date"), F.col("value")

    def by_month(kind: str) -> Column:
        return _listed(R.top_by_month(*tables, kind), F.col("month"), F.col("pos"))

    def top(kind: str) -> Column:
        return _listed(R.top_alltime(*tables, kind), -value, day, F.col("station_id"))

    def longest(kind: str) -> Column:
        return _listed(R.longest_standing(*tables, kind), day, F.col("station_id"))

    def active(mode: str) -> Column:
        return _listed(
            R.most_active(*tables, p, mode), -F.col("n"), F.col("name").isNull(),
            F.col("name"), F.col("station_id"),
        )

    return events.sparkSession.range(1).select(
        F.lit(generated_at).cast("string").alias("generated_at"),
        F.struct(top(ALL_MAX).alias("max"), top(ALL_MIN).alias("min")).alias("top_alltime"),
        F.struct(by_month(MONTH_MAX).alias("max"), by_month(MONTH_MIN).alias("min")).alias("top_by_month"),
        _listed(
            R.recent_records(*tables), -day, -margin(), F.col("station_id"), F.col("kind"),
            F.coalesce("month", F.lit(0)),
        ).alias("recent"),
        F.struct(longest(ALL_MAX).alias("max"), longest(ALL_MIN).alias("min")).alias("longest"),
        _listed(
            R.largest_margins(*tables), -F.col("margin"), -day, F.col("station_id"), F.col("kind")
        ).alias("margins"),
        F.struct(
            R.latest_event_year(events).scalar().alias("year"),
            active("year").alias("this_year"),
            active("12m").alias("last_12m"),
        ).alias("most_active"),
    )


# ---- JSON text ------------------------------------------------------------------------
#
# The keys of the published documents, in stats_json, rankings_json, _header, summary_json
# and station_json.


def _kind_name(kind: Column) -> Column:
    names = F.create_map(*[F.lit(x) for pair in KIND_NAMES.items() for x in pair])
    return J.scalar(F.try_element_at(names, kind))


def _tenth(value: Column) -> Column:
    return J.scalar(F.round(value, 1))


def stats_json(document: DataFrame) -> DataFrame:
    """``text`` of the aggregates document."""

    def group(g: Column) -> Column:
        return J.obj(
            {
                "id": J.scalar(g["group_id"]),
                "nombre": J.scalar(g["name"]),
                "nEstaciones": J.scalar(g["n_stations"]),
                "provinciasAemet": F.to_json(g["aliases"]),
            }
        )

    def grid(name: str) -> Column:
        members = F.transform(
            name, lambda g: F.concat(J.scalar(g["group_id"]), F.lit(":"), F.to_json(g["rows"]))
        )
        return F.concat(F.lit("{"), F.array_join(members, ","), F.lit("}"))

    return document.select(
        J.obj(
            {
                "generadoEn": J.scalar(F.col("generated_at")),
                "anioMin": J.scalar(F.col("year_min")),
                "anioMax": J.scalar(F.col("year_max")),
                "rowFields": F.to_json("row_fields"),
                "anios": F.to_json("years"),
                "ejeMensual": F.to_json("month_axis"),
                "grupos": J.mapped(F.col("groups"), group),
                "anual": grid("yearly"),
                "mensual": grid("monthly"),
            }
        ).alias("text")
    )


def rankings_json(document: DataFrame) -> DataFrame:
    """``text`` of the leaderboards document."""

    def who(r: Column) -> dict[str, Column]:
        return {
            "ind": J.scalar(r["station_id"]),
            "nombre": J.scalar(r["name"]),
            "prov": J.scalar(r["province"]),
        }

    def holder(r: Column) -> Column:
        always = who(r) | {
            "alt": J.scalar(r["altitude"]), "valor": _tenth(r["value"]), "fecha": J.iso(r["obs_date"]),
        }
        return J.obj(always)

    def month_holder(r: Column) -> Column:
        always = who(r) | {
            "alt": J.scalar(r["altitude"]), "valor": _tenth(r["value"]), "fecha": J.iso(r["obs_date"]),
        }
        return J.obj(always, [J.flag("abs", r["is_alltime"])])

    def recent(r: Column) -> Column:
        always = who(r) | {
            "tipo": _kind_name(r["kind"]), "mes": J.scalar(r["month"]),
            "valor": _tenth(r["value"]), "valorAnterior": _tenth(r["prev_value"]),
            "fecha": J.iso(r["obs_date"]), "provisional": J.scalar(r["provisional"]),
        }
        return J.obj(always, [J.flag("abs", r["is_alltime"])])

    def jump(r: Column) -> Column:
        return J.obj(
            who(r)
            | {
                "tipo": _kind_name(r["kind"]), "valor": _tenth(r["value"]),
                "valorAnterior": _tenth(r["prev_value"]), "salto": _tenth(r["margin"]),
                "fecha": J.iso(r["obs_date"]),
            }
        )

    def counted(r: Column) -> Column:
        return J.obj(who(r) | {"n": J.scalar(r["n"])})

    def both(name: str, to_text) -> Column:
        return J.obj({f: to_text(F.col(f"{name}.{f}")) for f in ("max", "min")})

    def months(rows: Column) -> Column:
        def of_month(m: Column) -> Column:
            held = J.mapped(F.filter(rows, lambda r: r["month"] == m), month_holder)
            return F.concat(F.lit('"'), m.cast("string"), F.lit('":'), held)

        members = F.transform(F.sequence(F.lit(1), F.lit(12)), of_month)
        return F.concat(F.lit("{"), F.array_join(members, ","), F.lit("}"))

    return document.select(
        J.obj(
            {
                "generadoEn": J.scalar(F.col("generated_at")),
                "topAbs": both("top_alltime", lambda c: J.mapped(c, holder)),
                "topMes": both("top_by_month", months),
                "recientes": J.mapped(F.col("recent"), recent),
                "longevos": both("longest", lambda c: J.mapped(c, holder)),
                "mayorSalto": J.mapped(F.col("margins"), jump),
                "masActivas": J.obj(
                    {
                        "anio": J.scalar(F.col("most_active.year")),
                        "esteAnio": J.mapped(F.col("most_active.this_year"), counted),
                        "ultimos12m": J.mapped(F.col("most_active.last_12m"), counted),
                    }
                ),
            }
        ).alias("text")
    )


def _header() -> dict[str, Column]:
    return {
        "indicativo": J.scalar(F.col("station_id")),
        "nombre": J.scalar(F.col("name")),
        "provincia": J.scalar(F.col("province")),
        "altitud": J.scalar(F.col("altitude")),
        "lat": J.scalar(F.col("lat")),
        "lon": J.scalar(F.col("lon")),
        "datosDesde": J.iso(F.col("first_date")),
        "datosHasta": J.iso(F.col("last_date")),
        "diasConDatos": J.scalar(F.col("n_days")),
    }


def _per_kind(prefix: str) -> Column:
    return J.obj({KIND_KEYS[k]: J.scalar(F.col(f"{prefix}_{k}")) for k in KINDS})


def _record(r: Column, *flags: Column) -> Column:
    always = {"fecha": J.iso(r["obs_date"]), "valor": J.scalar(r["value"])}
    return F.when(r.isNotNull(), J.obj(always, [J.flag("provisional", r["provisional"]), *flags]))


def summary_json(summary: DataFrame) -> DataFrame:
    """``station_id, text``: the element of each station in the map document."""

    def last(kind: str) -> Column:
        def field(name: str) -> Column:
            return F.col(f"last_{kind}_{name}")

        month = F.when(field("month").isNotNull(), F.concat(F.lit('"mes":'), field("month")))
        text = J.obj(
            {"fecha": J.iso(field("date")), "valor": J.scalar(field("value"))},
            [month, J.flag("provisional", field("provisional"))],
        )
        return F.when(field("date").isNotNull(), text)

    return summary.select(
        "station_id",
        J.obj(
            _header()
            | {
                "ultimoPorTipo": J.obj({KIND_KEYS[k]: last(k) for k in KINDS}),
                "recientes15d": _per_kind("recent15"),
                "totalRecordsAbsolutos": J.scalar(F.col("total_alltime")),
                "totalRecordsMensuales": J.scalar(F.col("total_monthly")),
                "totales": _per_kind("total"),
            }
        ).alias("text"),
    )


def summary_array_lines(summary: DataFrame) -> DataFrame:
    """The map document as sorted lines: its part files, one after the other, are one JSON array."""
    elements = summary_json(summary)
    bounds = elements.agg(F.min("station_id").alias("first"), F.max("station_id").alias("last"))
    first, last = bounds.select("first").scalar(), bounds.select("last").scalar()
    opening = F.when(F.col("station_id") == first, "[").otherwise(",")
    closing = F.when(F.col("station_id") == last, "]").otherwise("")
    return elements.orderBy("station_id").select(F.concat(opening, "text", closing).alias("text"))


def station_json(documents: DataFrame) -> DataFrame:
    """``station_id, text`` of each station document."""

    def event(e: Column) -> Column:
        return J.obj(
            {
                "fecha": J.iso(e["obs_date"]), "tipo": _kind_name(e["kind"]),
                "mes": J.scalar(e["month"]), "valor": J.scalar(e["value"]),
                "valorAnterior": J.scalar(e["prev_value"]),
                "diasDesdeAnterior": J.scalar(e["days_since_prev"]),
                "provisional": J.scalar(e["provisional"]),
            },
            [J.flag("inicial", e["initial"])],
        )

    def month(m: Column) -> Column:
        return J.obj(
            {"mes": J.scalar(m["month"])}
            | {f: _record(m[f], J.flag("abs", m[f]["is_alltime"])) for f in ("max", "min")}
        )

    def gap(g: Column) -> Column:
        return J.obj(
            {"desde": J.iso(g["gap_from"]), "hasta": J.iso(g["gap_to"]), "dias": J.scalar(g["n_days"])}
        )

    last = F.col("last_record")
    last_text = J.obj(
        {
            "fecha": J.iso(last["obs_date"]), "tipo": _kind_name(last["kind"]),
            "mes": J.scalar(last["month"]), "valor": J.scalar(last["value"]),
            "provisional": J.scalar(last["provisional"]),
        }
    )
    return documents.select(
        "station_id",
        J.obj(
            _header()
            | {
                "totales": _per_kind("total"),
                "vigentes": J.obj(
                    {
                        KIND_KEYS[ALL_MAX]: _record(F.col("current_max")),
                        KIND_KEYS[ALL_MIN]: _record(F.col("current_min")),
                    }
                ),
                "ultimoRecord": F.when(last.isNotNull(), last_text),
                "mensuales": J.mapped(F.col("months"), month),
                "eventos": J.mapped(F.col("events"), event),
                "sinDatos": J.mapped(F.col("gaps"), gap),
            }
        ).alias("text"),
    )
