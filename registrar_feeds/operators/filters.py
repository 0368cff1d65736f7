"""Row filters of the feeds.

All of them compare columns with literals derived from the run clock, so
Catalyst folds the bounds and pushes the predicates to the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registrar_feeds import fixed_values as V
from registrar_feeds.asof import AsOf
from registrar_feeds.functions import codes as C
from registrar_feeds.functions import dates as D


def term_window_pred(as_of: AsOf, start="start_date", end="end_date") -> Column:
    return D.in_month_window(start, end, as_of, V.TERM_MONTHS_AHEAD, V.TERM_MONTHS_BEHIND)


def term_window(terms: DataFrame, as_of: AsOf) -> DataFrame:
    """Terms starting within 6 months and not ended more than 1 month ago."""
    return terms.where(term_window_pred(as_of))


def meeting_window_pred(as_of: AsOf, start="beg_date", end="end_date") -> Column:
    return D.in_month_window(start, end, as_of, V.TERM_MONTHS_AHEAD, V.MEETING_MONTHS_BEHIND)


def meeting_window(meetings: DataFrame, as_of: AsOf) -> DataFrame:
    """Meetings starting within 6 months and not ended more than 3 months ago."""
    return meetings.where(meeting_window_pred(as_of))


def program_ok_by_term(term_code: str | Column) -> Column:
    """Last 4 of the trimmed term code not an excluded programme (null drops)."""
    return ~C.term_program(term_code).isin(*V.EXCLUDED_PROGRAMS)


def program_ok(prog: str | Column) -> Column:
    """Trimmed programme not an excluded one (null drops)."""
    return ~C.trim(prog).isin(*V.EXCLUDED_PROGRAMS)


def recent_cancellation_pred(as_of: AsOf) -> Column:
    """Cancelled, not yet ended, status changed within the last 4 days.

    Strict on both dates; no upper bound on the status date.
    """
    return ((F.col("stat") == V.CANCELLED_STAT)
            & (F.col("end_date") > as_of.today_lit())
            & (F.col("stat_date") > D.days_before_today(as_of, V.RECENT_CANCEL_DAYS)))


def recent_cancellations(sections: DataFrame, as_of: AsOf) -> DataFrame:
    return sections.where(recent_cancellation_pred(as_of))


def status_ok(status_code: str | Column = "status_code") -> Column:
    """Status not excluded; a null status is dropped too (NOT IN is unknown)."""
    return ~C.col(status_code).isin(*V.EXCLUDED_STATUSES)


def open_or_future(end_date: str | Column, as_of: AsOf) -> Column:
    """No end date, or an end date after now (a date ending today has ended).

    A date compares with the run timestamp as its midnight, so for a date
    column ``> now`` is ``> today``.
    """
    e = C.col(end_date)
    return e.isNull() | (e > as_of.today_lit())


def open_titles(jobs: DataFrame, ranks, as_of: AsOf) -> DataFrame:
    """Jobs of the given title rank(s) that are open and have a title."""
    ranks = [ranks] if isinstance(ranks, int) else list(ranks)
    return jobs.where(F.col("title_rank").isin(*ranks) & open_or_future("end_date", as_of)
                      & F.col("job_title").isNotNull())


def faculty_standing(prog_enr: DataFrame) -> DataFrame:
    """Programme enrolments in good standing with tle = 'Y'."""
    return prog_enr.where(F.col("acst").isin(*V.GOOD_STANDING) & (F.col("tle") == V.TLE_FLAG))


def preferred_names(addresses: DataFrame) -> DataFrame:
    return addresses.where(F.col("style") == V.PREFERRED_NAME_STYLE)


def audit_recent_pred(as_of: AsOf, ts: str = "audit_timestamp", day: str = "audit_date",
                      month: str = "audit_month") -> Column:
    """Audit images after yesterday 00:00 (exclusive).

    The staged audit date and month carry the implied bounds of yesterday: they
    change no result, and one of them is the folder the images lie in.
    """
    first = as_of.days_ago(V.AUDIT_DAYS_BACK)
    return ((F.col(day) >= F.lit(first)) & (F.col(month) >= F.lit(f"{first:%Y-%m}"))
            & (F.col(ts) > as_of.midnight_lit(V.AUDIT_DAYS_BACK)))


def in_list(column: str | Column, values: DataFrame, of: str) -> Column:
    """Whether ``column`` is among the values of ``of``; a null is not.

    The list is a scalar subquery, read when the plan runs and once for all
    scans that use it: a filter on a partition column then opens those folders
    alone, whatever the planner broadcasts or shuffles.  Meant for the codes of
    folders (years, terms), of which there are no more than folders.
    """
    return F.array_contains(values.agg(F.collect_set(of)).scalar(), C.col(column))
