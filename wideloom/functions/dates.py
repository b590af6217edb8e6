"""Date helpers that do not depend on the session time zone.

Timestamps in the driver tables load as ``timestamp_ntz``; we stay with
wall-clock NTZ values and explicit zones so results are identical whatever
``spark.sql.session.timeZone`` the caller runs with.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..params import AsOf

_EPOCH_NTZ = "timestamp_ntz'1970-01-01 00:00:00'"


def asof_lit(asof: AsOf | dt.date) -> Column:
    day = asof.day if isinstance(asof, AsOf) else asof
    return F.lit(day)


def as_date(c: Column | str) -> Column:
    """Any timestamp/date column -> DATE (NTZ cast: no zone shift)."""
    return F.to_date(F.col(c) if isinstance(c, str) else c)


def window_lower(asof: AsOf, name: str) -> Column:
    """Inclusive lower bound of a named window as a literal (folded by Catalyst)."""
    return F.lit(asof.lower_bound(name))


def datediff_days(later: Column, earlier: Column) -> Column:
    return F.datediff(later, earlier)


def epoch_millis_of(ts_ntz: Column) -> Column:
    """Wall-clock NTZ timestamp read as UTC -> epoch milliseconds."""
    return F.timestamp_diff("MILLISECOND", F.expr(_EPOCH_NTZ), ts_ntz)


def format_epoch_millis(ms: Column, fmt: str, zone: str = "UTC") -> Column:
    """Epoch milliseconds -> text in ``fmt`` at ``zone`` (session zone ignored)."""
    utc_wall = F.timestamp_add("MILLISECOND", ms, F.expr(_EPOCH_NTZ))
    wall = utc_wall if zone.upper() == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(zone), utc_wall)
    return F.date_format(wall, fmt)


def reformat_date_text(text: Column, in_fmt: str, out_fmt: str) -> Column:
    """Date/time text in ``in_fmt`` -> text in ``out_fmt``; null when unparsable."""
    # parse and format happen in the same (session) zone, so the wall clock
    # is preserved whatever that zone is
    parsed = F.try_to_timestamp(text, F.lit(in_fmt)).cast("timestamp_ntz")
    return F.date_format(parsed, out_fmt)


def date_text_to_millis(text: Column, in_fmt: str, zone: str = "UTC") -> Column:
    """Date/time text in ``in_fmt``, read at ``zone``, -> epoch milliseconds; null when unparsable
    (session zone ignored)."""
    # parsed and cast in the session zone, which leaves the wall clock as written
    wall = F.try_to_timestamp(text, F.lit(in_fmt)).cast("timestamp_ntz")
    utc = wall if zone.upper() == "UTC" else F.convert_timezone(F.lit(zone), F.lit("UTC"), wall)
    return epoch_millis_of(utc)


def mysql_week_plus_one(d: Column) -> Column:
    """Week number with Monday as first day, range 0-53, week 1 being the first
    week with four or more days in the year (MySQL ``%u``), plus one.

    weekday(): Monday = 0.  Days before the first Monday-started week that has
    four days in the year fall in week 0.
    """
    jan1 = F.trunc(d, "year")
    jan1_wd = F.weekday(jan1)
    doy0 = F.dayofyear(d) - 1
    base = F.floor((doy0 + jan1_wd) / F.lit(7)).cast("int")
    return base + F.when(jan1_wd <= 3, F.lit(1)).otherwise(F.lit(0)) + F.lit(1)
