"""Row-by-row counterparts of the set-based jobs, for small inputs only."""

from __future__ import annotations

from datetime import date, timedelta


def ladder(rows, warmup=365, gap_reset=180):
    """Events of ``(station, day, tmax, tmin, provisional)`` rows, walked day by day."""
    by_station: dict = {}
    for station, day, tmax, tmin, prov in rows:
        if tmax is not None or tmin is not None:
            by_station.setdefault(station, []).append((day, tmax, tmin, bool(prov)))
    events = []
    for station, days in by_station.items():
        best: dict = {}
        open_rungs: dict = {}
        found: dict = {}
        segment, start, last = 0, None, None
        for day, tmax, tmin, prov in sorted(days):
            if last is None or (day - last).days >= gap_reset:
                segment, start = segment + 1, day
            last = day
            mature = (day - start).days >= warmup
            for kind, month, value in (
                ("all_max", None, tmax), ("all_min", None, tmin),
                ("month_max", day.month, tmax), ("month_min", day.month, tmin),
            ):
                key = (kind, month)
                if value is None or (key in best and value <= best[key]):
                    continue
                prev = best.get(key) if mature else None
                best[key] = value
                rung = [day, value, prev, prov]
                slots = found.setdefault(key, [])
                if prev is None:
                    earlier = open_rungs.get((key, segment))
                    if earlier is not None:
                        slots.remove(earlier)
                    open_rungs[(key, segment)] = rung
                slots.append(rung)
        for (kind, month), rungs in found.items():
            before = None
            for day, value, prev, prov in sorted(rungs):
                since = (day - before).days if before else None
                events.append((station, kind, day, month, value, prev, prov, since))
                before = day
    return sorted(events, key=repr)


def windows_to_read(cutoff: date, hits: set, failed: set, floor_year: int, empty_stop: int):
    """Starts of the half-years read back from ``cutoff``, and whether the series ran dry."""
    read, empty = [], 0
    for year in range(cutoff.year, floor_year - 1, -1):
        for month in (7, 1):
            start = date(year, month, 1)
            if start >= cutoff:
                continue
            read.append(start)
            if start in failed:
                continue
            empty = 0 if start in hits else empty + 1
            if empty >= empty_stop:
                return read, True
    return read, False


def half_year(day: date) -> date:
    return date(day.year, 1 if day.month <= 6 else 7, 1)


def day_range(first: date, n: int):
    return [first + timedelta(days=i) for i in range(n)]
