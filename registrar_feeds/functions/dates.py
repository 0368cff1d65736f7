"""Date rules: month windows around the run date, day offsets, gates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from registrar_feeds import fixed_values as V
from registrar_feeds.asof import AsOf


def months_from_today(as_of: AsOf, n: int) -> Column:
    """ADD_MONTHS(today, n), end of month clamped; folds to a literal."""
    return F.add_months(as_of.today_lit(), n)


def days_before_today(as_of: AsOf, n: int) -> Column:
    return F.date_sub(as_of.today_lit(), n)


def in_month_window(start: str | Column, end: str | Column, as_of: AsOf,
                    ahead: int, behind: int) -> Column:
    """start <= today + ahead months AND end >= today - behind months."""
    s = F.col(start) if isinstance(start, str) else start
    e = F.col(end) if isinstance(end, str) else end
    return (s <= months_from_today(as_of, ahead)) & (e >= months_from_today(as_of, -behind))


def preff_gate_open(as_of: AsOf) -> bool:
    """The role exclusion holds only in the seasonal months."""
    return as_of.today.month in V.PREFF_MONTHS


def digest_gate_open(as_of: AsOf) -> bool:
    """The cancellation digest goes out only after the digest hour."""
    return as_of.ts.hour > V.DIGEST_AFTER_HOUR
