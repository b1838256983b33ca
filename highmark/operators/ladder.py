"""Record ladder: every "highest so far" day of a station, all-time and per calendar month.

Input is one row per station and day (``resolve_observations`` makes it so).

Physical shape of ``record_events``, two shuffles:

1. rows go to blocks of (station, calendar month, run of years), at most 31 days per
   year, so even a station holding a third of the table is spread over many tasks.
   A day whose value does not beat the earlier days of its own block cannot be a rung,
   and a coverage gap can only be seen from the first and last day of a month or from
   a gap inside it. All other days are dropped here, which on daily series leaves
   roughly a tenth of the rows;
2. the remaining rows go to their station, where the exact running maxima, segments
   and ladder are computed. Every later window reuses that partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from highmark.functions.predicates import has_temperature, is_beaten, is_provisional
from highmark.params import RunParams
from highmark.schemas import ALL_MAX, ALL_MIN, EVENT_COLUMNS, KINDS, MONTH_MAX, MONTH_MIN

_EARLIER = (Window.unboundedPreceding, -1)
_SO_FAR = (Window.unboundedPreceding, Window.currentRow)


def _by_date(*keys: str) -> Window:
    return Window.partitionBy(*keys).orderBy("obs_date")


def _beats(value: Column, previous: Column) -> Column:
    """Strictly above everything earlier, or first of all; NULL values never count."""
    return value.isNotNull() & (previous.isNull() | (value > previous))


def _highest_before(column: str, window: Window) -> Column:
    return F.max(column).over(window.rowsBetween(*_EARLIER))


def _with_segments(days: DataFrame, gap: Column, p: RunParams) -> DataFrame:
    """Number the runs of days that no gap of ``gap_reset_days`` interrupts."""
    opens = F.coalesce((gap >= p.gap_reset_days).cast("int"), F.lit(0))
    so_far = _by_date("station_id").rowsBetween(*_SO_FAR)
    # by the order of days that the rows are in, as a window of the segments would sort them once more
    opened = F.max(F.when(F.col("opens") == 1, F.col("obs_date"))).over(so_far)
    first = F.min("obs_date").over(Window.partitionBy("station_id"))
    return (
        days.withColumn("opens", opens)
        .withColumn("seg_id", F.sum("opens").over(so_far))
        .withColumn("seg_start", F.coalesce(opened, first))
        .withColumn("mature", F.col("obs_date") >= F.date_add("seg_start", p.warmup_days))
    )


def coverage_segments(obs: DataFrame, p: RunParams) -> DataFrame:
    """Segment and maturity of every day with a temperature.

    Two columns travel, and a station has one row per calendar day at most.
    """
    days = obs.filter(has_temperature()).select("station_id", "obs_date")
    gap = F.datediff("obs_date", F.lag("obs_date").over(_by_date("station_id")))
    return _with_segments(days.withColumn("gap", gap), F.col("gap"), p).select(
        "station_id", "obs_date", "seg_id", "seg_start", "mature"
    )


def _ladder_days(obs: DataFrame, p: RunParams) -> DataFrame:
    """Days that can be a rung or bound a coverage gap (step 1 of the module text)."""
    block = _by_date("station_id", "month", "year_run")
    month_start = F.trunc("obs_date", "month")
    days = (
        obs.filter(has_temperature())
        .select(
            "station_id",
            "obs_date",
            F.month("obs_date").alias("month"),
            F.floor(F.year("obs_date") / p.block_years).cast("int").alias("year_run"),
            "tmax",
            "tmin",
            is_provisional().alias("provisional"),
        )
        .withColumn("before", F.lag("obs_date").over(block))
        .withColumn("after", F.lead("obs_date").over(block))
        .withColumn("block_max", _highest_before("tmax", block))
        .withColumn("block_min", _highest_before("tmin", block))
        .withColumn(
            "gap_in_month",
            F.when(F.col("before") >= month_start, F.datediff("obs_date", "before")),
        )
    )
    first_of_month = F.col("gap_in_month").isNull()
    last_of_month = F.col("after").isNull() | (F.col("after") > F.last_day("obs_date"))
    return days.filter(
        first_of_month
        | last_of_month
        | (F.col("gap_in_month") >= p.gap_reset_days)
        | _beats(F.col("tmax"), F.col("block_max"))
        | _beats(F.col("tmin"), F.col("block_min"))
    ).select(
        "station_id", "obs_date", "month", "tmax", "tmin", "provisional", "gap_in_month"
    )


def _rungs(obs: DataFrame, p: RunParams) -> DataFrame:
    """One row per rung and kind, with segment, and ``prev_value`` only where mature."""
    station = _by_date("station_id")
    month = _by_date("station_id", "month")
    days = (
        _ladder_days(obs, p)
        .withColumn("day_before", F.lag("obs_date").over(station))
        .withColumn("prev_all_max", _highest_before("tmax", station))
        .withColumn("prev_all_min", _highest_before("tmin", station))
    )
    gap = F.coalesce("gap_in_month", F.datediff("obs_date", "day_before"))
    days = (
        _with_segments(days, gap, p)
        .withColumn("prev_month_max", _highest_before("tmax", month))
        .withColumn("prev_month_min", _highest_before("tmin", month))
    )

    def rung(kind: str, month_of: Column, value: str, previous: str) -> Column:
        return F.when(
            _beats(F.col(value), F.col(previous)),
            F.struct(
                F.lit(kind).alias("kind"),
                month_of.cast("int").alias("month"),
                F.col(value).alias("value"),
                F.when(F.col("mature"), F.col(previous)).alias("prev_value"),
            ),
        )

    # An all-time rung also beats its own calendar month, so the monthly tests cover both.
    any_rung = _beats(F.col("tmax"), F.col("prev_month_max")) | _beats(
        F.col("tmin"), F.col("prev_month_min")
    )
    kinds = F.array_compact(
        F.array(
            rung(ALL_MAX, F.lit(None), "tmax", "prev_all_max"),
            rung(ALL_MIN, F.lit(None), "tmin", "prev_all_min"),
            rung(MONTH_MAX, F.col("month"), "tmax", "prev_month_max"),
            rung(MONTH_MIN, F.col("month"), "tmin", "prev_month_min"),
        )
    )
    return days.filter(any_rung).select(
        "station_id", "obs_date", "seg_id", "provisional", F.inline(kinds)
    )


def record_events(obs: DataFrame, p: RunParams) -> DataFrame:
    """The full ladder.

    Rungs without ``prev_value`` (first of a series, or set during warm-up) are reduced
    to the highest of their segment. Values rise with the date and warm-up comes first
    in a segment, so that one is simply the last before a beaten rung or a new segment.
    """
    ladder = _by_date("station_id", "kind", "month")
    next_starts_anew = (
        F.col("next_seg").isNull()
        | (F.col("next_seg") != F.col("seg_id"))
        | F.col("next_prev").isNotNull()
    )
    return (
        _rungs(obs, p)
        .withColumn("next_seg", F.lead("seg_id").over(ladder))
        .withColumn("next_prev", F.lead("prev_value").over(ladder))
        .filter(is_beaten() | next_starts_anew)
        .withColumn(
            "days_since_prev", F.datediff("obs_date", F.lag("obs_date").over(ladder))
        )
        .select(*EVENT_COLUMNS)
    )


def new_record_events(events: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    """Beaten events that the previous run did not have; none at all without a previous run."""
    beaten = events.filter(is_beaten())
    if previous is None:
        return beaten.filter(F.lit(False))
    old = previous.filter(is_beaten())
    same = (
        (beaten.station_id == old.station_id)
        & (beaten.kind == old.kind)
        & beaten.month.eqNullSafe(old.month)
        & (beaten.obs_date == old.obs_date)
        & (beaten.value == old.value)
        & (beaten.provisional == old.provisional)
    )
    return beaten.join(old, same, "left_anti").select(*EVENT_COLUMNS)


def refresh_record_events(
    obs: DataFrame, previous: DataFrame, changed: DataFrame, p: RunParams
) -> DataFrame:
    """``record_events`` after a batch that touched only the stations in ``changed``.

    A correction can remove a rung and older history can insert one, so a touched
    station is computed anew from its whole series; all others keep their rows.
    """
    ids = changed.select("station_id").distinct()
    redone = record_events(obs.join(ids, "station_id", "left_semi"), p)
    kept = previous.join(ids, "station_id", "left_anti").select(*EVENT_COLUMNS)
    return redone.unionByName(kept)


def display_order() -> list[Column | str]:
    """Sort columns of a published ladder: station, kind, month, day."""
    return [
        "station_id", F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")), F.coalesce("month", F.lit(0)), "obs_date"
    ]
