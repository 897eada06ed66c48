"""Run parameters: everything a model would otherwise take from a clock, a random source or a constant."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from millrace import allowlists


@dataclass(frozen=True)
class Params:
    as_of: dt.date
    load_ts: dt.datetime
    seed: str = "0"
    # "reference" keeps the published semantics including their defects, "fixed" repairs them.
    mode: str = "fixed"
    departments: tuple[str, ...] = field(default=allowlists.DEPARTMENTS)
    positions: tuple[str, ...] = field(default=allowlists.POSITIONS)
    levels: tuple[str, ...] = field(default=allowlists.LEVELS)
    # First day of the reporting calendar and how many years of year-end facts are kept.
    calendar_start: dt.date = dt.date(2005, 1, 1)
    fact_years: int = 20
    forecast_years: int = 5

    def __post_init__(self) -> None:
        if self.mode not in ("reference", "fixed"):
            raise ValueError(f"unknown mode {self.mode!r}")
