"""Run parameters. Every job takes them as an argument; nothing reads a clock or a global."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date


@dataclass(frozen=True)
class RunParams:
    as_of: date

    # Defaults of the reference pipeline.
    active_min_days: int = 180
    warmup_days: int = 365
    gap_reset_days: int = 180
    export_gap_min_days: int = 7
    ingest_lag_days: int = 3
    provisional_max_age_days: int = 15
    min_year: int = 1920
    min_backfill_year: int = 1975
    history_floor_year: int = 1920
    empty_stop: int = 4
    chunk_days: int = 15
    default_backstop: date = field(default=date(2024, 1, 1))
    summary_back_days: int = 7
    summary_max_offset_days: int = 8
    recent_days: int = 15
    local_tz: str = "Europe/Madrid"

    # Width, in years, of the blocks that the ladder prunes before the per-station pass.
    block_years: int = 10
