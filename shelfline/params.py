"""Run parameters.

Every date the models depend on is an explicit argument here; nothing reads the
wall clock.  The defaults fit the driver's test tables (orders 1995-01-01 ..
2001-08-01): the calendar spans the data with a year of slack on each side and
the inventory window opens one month before the as-of day, the same position
the original project's ``2025-07-01`` start had relative to its data.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Params:
    # "today" for the models that used current_date() (inventory spine end)
    as_of: dt.date = dt.date(2001, 8, 1)
    # calendar dimension range, both ends inclusive
    calendar_start: dt.date = dt.date(1994, 1, 1)
    calendar_end: dt.date = dt.date(2002, 12, 31)
    # first day of the dense inventory snapshot
    window_start: dt.date = dt.date(2001, 7, 1)
    # inventory policy, in weeks
    lead_weeks: float = 2
    safety_weeks: float = 1
    target_weeks: float = 4
    overstock_weeks_of_cover: float = 26
    # incremental facts reprocess max(partition) - lookback_days and later
    lookback_days: int = 3
    # forecast horizon in weeks
    horizon: int = 8
    # source freshness thresholds, hours
    freshness_warn_hours: int = 24
    freshness_error_hours: int = 72

    def with_(self, **kw) -> "Params":
        return replace(self, **kw)


DEFAULT = Params()
