"""The ladder as a state that new days extend, instead of a fold over the whole table.

Days up to a settled day are folded once. What later days need of them is one row per station:

* ``last_day`` and ``seg_start``, from which the next gap and maturity follow;
* ``tops``, the last rung of each kind and month, at most 26. Its value is the highest so far, as
  rungs only rise; its date gives ``days_since_prev`` of the next rung.

A rung is *open* while a later day could still replace it: it is the last of its kind, beats nothing, and
its segment goes on. All others are *closed* and never change, so their table only grows. The ladder at
any time is the closed rungs, and what the state and the days after the settled one add.

``whole`` (of series) and ``walk`` (of a state and later days) give rungs with all that the three results
need: ``closed_rungs``, ``state_of`` and ``added_events``. Store them once and take these from there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from highmark.functions.predicates import has_temperature, is_beaten, is_provisional
from highmark.operators.ladder import _beats, coverage_segments, record_events
from highmark.params import RunParams
from highmark.schemas import ALL_MAX, ALL_MIN, EVENT_COLUMNS, MONTH_MAX, MONTH_MIN

STATE = (
    "station_id string, last_day date, seg_start date, tops array<struct<kind:string,month:int,obs_date:date,"
    "value:double,prev_value:double,provisional:boolean,days_since_prev:int,open:boolean>>"
)
EVENTS = (
    "station_id string, kind string, obs_date date, month int, value double, prev_value double, "
    "provisional boolean, days_since_prev int"
)
RUNGS = f"{EVENTS}, last_day date, seg_start date, is_last boolean, open boolean, added boolean"
_COLUMNS = [c.split()[0] for c in RUNGS.split(", ")]
_RUNG = ["station_id", "kind", "month"]


def _open(seg_start: str) -> Column:
    """Of the last rung of its kind: whether a later day of the segment can still replace it."""
    return ~is_beaten() & (F.col("obs_date") >= F.col(seg_start))


def whole(obs: DataFrame, p: RunParams) -> DataFrame:
    """``RUNGS`` of whole series; for a first load, and for stations whose settled days changed."""
    heads = coverage_segments(obs, p).groupBy("station_id").agg(
        F.max("obs_date").alias("last_day"), F.max("seg_start").alias("seg_start")
    )
    is_last = F.lead("obs_date").over(Window.partitionBy(*_RUNG).orderBy("obs_date")).isNull()
    rungs = record_events(obs, p).join(heads, "station_id").withColumn("is_last", is_last)
    return rungs.withColumns({"open": F.col("is_last") & _open("seg_start"), "added": F.lit(True)}).select(*_COLUMNS)


def _new_rungs(state: DataFrame, days: DataFrame, p: RunParams) -> DataFrame:
    """Rungs of ``days``, which all come after the state, with their segment counted from the state's."""
    station = Window.partitionBy("station_id").orderBy("obs_date")
    month = Window.partitionBy("station_id", "month").orderBy("obs_date")
    keyed = F.map_from_entries(
        F.transform("tops", lambda t: F.struct(F.concat_ws("-", t["kind"], t["month"]), t["value"]))
    )
    known = state.select("station_id", "last_day", F.col("seg_start").alias("known_start"), keyed.alias("highest"))
    days = (
        days.filter(has_temperature())
        .select("station_id", "obs_date", F.month("obs_date").alias("month"), "tmax", "tmin", is_provisional().alias("provisional"))
        .join(known, "station_id", "left")
    )
    gap = F.datediff("obs_date", F.coalesce(F.lag("obs_date").over(station), F.col("last_day")))
    days = days.withColumn("opens", F.coalesce((gap >= p.gap_reset_days).cast("int"), F.lit(0)))
    days = days.withColumn("seg_id", F.sum("opens").over(station.rowsBetween(Window.unboundedPreceding, 0)))
    begins = F.min("obs_date").over(Window.partitionBy("station_id", "seg_id"))
    days = days.withColumn(
        "seg_start", F.coalesce(F.when(F.col("seg_id") == 0, F.col("known_start")), begins)
    ).withColumn("mature", F.col("obs_date") >= F.date_add("seg_start", p.warmup_days))

    def before(value: str, kind: str, window: Window) -> Column:
        monthly = kind in (MONTH_MAX, MONTH_MIN)
        key = F.concat_ws("-", F.lit(kind), F.col("month")) if monthly else F.lit(kind)
        return F.greatest(
            F.try_element_at("highest", key), F.max(value).over(window.rowsBetween(Window.unboundedPreceding, -1))
        )

    kinds = ((ALL_MAX, "tmax", station), (ALL_MIN, "tmin", station), (MONTH_MAX, "tmax", month), (MONTH_MIN, "tmin", month))
    days = days.withColumns({f"before_{kind}": before(value, kind, window) for kind, value, window in kinds})
    rungs = F.array_compact(
        F.array(
            *[
                F.when(
                    _beats(F.col(value), F.col(f"before_{kind}")),
                    F.struct(
                        F.lit(kind).alias("kind"),
                        (F.col("month") if window is month else F.lit(None)).cast("int").alias("month"),
                        F.col(value).alias("value"),
                        F.when(F.col("mature"), F.col(f"before_{kind}")).alias("prev_value"),
                    ),
                )
                for kind, value, window in kinds
            ]
        )
    )
    return days.select("station_id", "obs_date", "seg_id", "seg_start", "provisional", rungs.alias("rungs"))


def walk(state: DataFrame, days: DataFrame, p: RunParams) -> DataFrame:
    """``RUNGS`` of the stations of ``state`` and of ``days``, which come after it."""
    found = _new_rungs(state, days, p)
    newest = found.groupBy("station_id").agg(F.max("obs_date").alias("new_day"), F.max("seg_start").alias("new_start"))
    heads = state.select("station_id", "last_day", "seg_start").join(newest, "station_id", "full_outer").select(
        "station_id", F.coalesce("new_day", "last_day").alias("last_day"), F.coalesce("new_start", "seg_start").alias("seg_start")
    )
    fresh = found.select("station_id", "obs_date", "seg_id", "provisional", F.inline("rungs")).select(
        *_RUNG, "obs_date", "value", "prev_value", "provisional", F.col("seg_id").cast("int").alias("seg_id"),
        F.lit(None).cast("date").alias("before"), F.lit(True).alias("added"),
    )
    # a rung that is not open cannot be replaced, as if its segment had ended
    carried = state.select("station_id", F.inline("tops")).select(
        *_RUNG, "obs_date", "value", "prev_value", "provisional", F.when(F.col("open"), 0).otherwise(-1).alias("seg_id"),
        F.date_sub("obs_date", F.col("days_since_prev")).alias("before"), F.col("open").alias("added"),
    )
    ladder = Window.partitionBy(*_RUNG).orderBy("obs_date")
    starts_anew = (
        F.col("next_seg").isNull() | (F.col("next_seg") != F.col("seg_id")) | F.col("next_prev").isNotNull()
    )
    kept = (
        carried.unionByName(fresh)
        .withColumn("next_seg", F.lead("seg_id").over(ladder))
        .withColumn("next_prev", F.lead("prev_value").over(ladder))
        .withColumn("before", F.first("before").over(ladder.rowsBetween(Window.unboundedPreceding, 0)))
        .filter(is_beaten() | starts_anew)
        .withColumn("days_since_prev", F.datediff("obs_date", F.coalesce(F.lag("obs_date").over(ladder), F.col("before"))))
        .withColumn("is_last", F.col("next_seg").isNull())
    )
    return kept.join(heads, "station_id").withColumn("open", F.col("is_last") & _open("seg_start")).select(*_COLUMNS)


def added_events(rungs: DataFrame) -> DataFrame:
    """Events that the closed rungs of before lack: new ones, and open ones that stay."""
    return rungs.filter("added").select(*EVENT_COLUMNS)


def closed_rungs(rungs: DataFrame) -> DataFrame:
    """Events that have become final."""
    return rungs.filter("added AND NOT open").select(*EVENT_COLUMNS)


def state_of(rungs: DataFrame) -> DataFrame:
    """One row per station. Every station with a temperature has a rung."""
    top = F.struct("kind", "month", "obs_date", "value", "prev_value", "provisional", "days_since_prev", "open")
    return rungs.groupBy("station_id").agg(
        F.max("last_day").alias("last_day"),
        F.max("seg_start").alias("seg_start"),
        F.sort_array(F.collect_list(F.when(F.col("is_last"), top))).alias("tops"),
    )
