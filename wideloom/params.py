"""Run parameters: the as-of day, the time slot and the named look-back windows.

Window lower bounds are inclusive and, as in the original jobs, there is no
upper bound by default (rows dated after the as-of day still count).  The
"30D/90D/120D/180D/360D" names are calendar months / one calendar year, not
day counts.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

# Window name -> (unit, amount) back from the as-of day.
WINDOWS: dict[str, tuple[str, int]] = {
    "1D": ("day", 1),
    "15D": ("day", 15),
    "30D": ("month", 1),
    "90D": ("month", 3),
    "120D": ("month", 4),
    "180D": ("month", 6),
    "360D": ("month", 12),
}


@dataclass(frozen=True)
class AsOf:
    """As-of day plus time slot.  ``upper`` adds an as-of upper bound."""

    day: dt.date
    slot: str = "00"
    upper: bool = False
    windows: dict = field(default_factory=lambda: dict(WINDOWS), hash=False)

    def lower_bound(self, name: str) -> dt.date:
        unit, amount = self.windows[name]
        if unit == "day":
            return self.day - dt.timedelta(days=amount)
        return add_months(self.day, -amount)

    @property
    def ymd(self) -> str:
        return self.day.strftime("%Y%m%d")


def add_months(day: dt.date, months: int) -> dt.date:
    """Calendar month shift with end-of-month clamping (Mar 31 - 1 = Feb 28)."""
    total = day.year * 12 + (day.month - 1) + months
    year, month = divmod(total, 12)
    month += 1
    last = (dt.date(year + (month == 12), month % 12 + 1, 1) - dt.timedelta(days=1)).day
    return dt.date(year, month, min(day.day, last))


def resolve_asof(args: list[str], today: dt.date | None = None) -> AsOf:
    """Argument convention of the batch jobs.

    two args with a real date -> (date, slot); one arg -> (date, "00");
    anything else -> yesterday with slot "00".
    """
    if len(args) == 2 and str(args[0]) != "None":
        return AsOf(parse_day(args[0]), args[1])
    if len(args) == 1:
        return AsOf(parse_day(args[0]), "00")
    today = today or dt.date.today()
    return AsOf(today - dt.timedelta(days=1), "00")


def parse_day(text: str) -> dt.date:
    text = text.strip()
    for fmt in ("%Y-%m-%d", "%Y%m%d", "%Y-%m-%d %H:%M:%S"):
        try:
            return dt.datetime.strptime(text, fmt).date()
        except ValueError:
            continue
    raise ValueError(f"unrecognised as-of day: {text!r}")


# As-of days used with the driver test tables (orders run to 2001-08-01 and
# events to 2024-01-30, so the missing upper bound is exercised).
ORDER_ASOF = AsOf(dt.date(2001, 6, 15), slot="F")
EVENT_ASOF = AsOf(dt.date(2024, 1, 25), slot="00")
