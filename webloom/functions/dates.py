"""Date-time Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Date-time text layout of the reference (fixed value).
DATETIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_datetime(s) -> Column:
    """Timestamp from trimmed 'yyyy-MM-ddTHH:mm:ss' text (session time zone).
    Strict: impossible dates are errors under ANSI mode, null otherwise."""
    return F.to_timestamp(F.trim(_c(s)), DATETIME_FORMAT)


def format_datetime(ts) -> Column:
    return F.date_format(_c(ts), DATETIME_FORMAT)


def parse_datetime_ntz(s) -> Column:
    """Zone-less variant of ``parse_datetime`` (TIMESTAMP_NTZ)."""
    return F.to_timestamp_ntz(F.trim(_c(s)), F.lit(DATETIME_FORMAT))


_EPOCH_NTZ = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def epoch_units(ts, unit: str = "MILLISECOND") -> Column:
    """Whole ``unit``s since 1970-01-01 of a zone-less timestamp; independent of
    the session time zone (no conversion through it)."""
    return F.timestamp_diff(unit, F.expr(_EPOCH_NTZ), _c(ts))


def seconds_between(t1, t2) -> Column:
    """Whole seconds from t1 to t2: millisecond difference / 1000, truncated
    toward 0.  Zone-less timestamps are compared as they are (no session-zone
    shift, so a daylight-saving change cannot add an hour)."""
    ms = epoch_units(t2) - epoch_units(t1)
    return (ms / F.lit(1000)).cast("long")
