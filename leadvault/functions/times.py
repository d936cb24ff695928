"""Time helpers. Results never read the clock: the caller passes ``as_of``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leadvault.functions.numeric import flag
from leadvault.functions.text import _col


def as_timestamp(value: str) -> Column:
    """Literal timestamp without zone."""
    return F.lit(value).cast("timestamp_ntz")


def as_date(value: str) -> Column:
    return F.lit(value).cast("date")


def days_between(start, as_of: str) -> Column:
    """Complete days from ``start`` to ``as_of``."""
    return F.timestamp_diff("DAY", _col(start).cast("timestamp_ntz"), as_timestamp(as_of))


def is_recent(c, as_of: str, days: int = 30) -> Column:
    """True for times not older than ``days`` before ``as_of``."""
    return flag(_col(c) >= (as_timestamp(as_of) - F.expr(f"interval {int(days)} days")))


def is_current(end_col, as_of: str) -> Column:
    """True for versions still open at ``as_of``."""
    return _col(end_col).isNull() | (_col(end_col) > as_timestamp(as_of))


def partition_expr(c, strategy: str = "daily") -> Column:
    """Partition value for a load date: its day, week (from Monday) or month, else the column."""
    unit = {"daily": "day", "weekly": "week", "monthly": "month"}.get(strategy)
    return F.date_trunc(unit, _col(c)).cast("timestamp_ntz") if unit else _col(c)
