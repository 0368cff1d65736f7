"""Column helpers: the text codes and formatting rules of the feeds.

Everything here is a built-in Spark expression (no Python UDF), so the feeds
stay inside whole-stage code generation.  Concatenation is ``F.concat``, which,
like SQL ``||``, is null if any part is null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from registrar_feeds import fixed_values as V


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cat(*parts: str | Column) -> Column:
    """Null-propagating concatenation; plain ``str`` parts are literals.

    Numeric parts become text by Spark's implicit cast (as with ``||``).
    """
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def trim(c: str | Column) -> Column:
    return F.trim(col(c))


def left(c: str | Column, n: int) -> Column:
    return F.left(col(c), F.lit(n))


def right(c: str | Column, n: int) -> Column:
    return F.right(col(c), F.lit(n))


def substr(c: str | Column, start: int, length: int) -> Column:
    """SUBSTRING(c FROM start FOR length), 1-based."""
    return F.substring(col(c), start, length)


def nvl(c: str | Column, default) -> Column:
    return F.coalesce(col(c), default if isinstance(default, Column) else F.lit(default))


# --- composite codes ---------------------------------------------------------

def course_code(crs_no, cat_) -> Column:
    """``crs_no (cat)``."""
    return cat(trim(crs_no), " (", trim(cat_), ")")


def term_code(sess, yr, prog) -> Column:
    """``SS YYYY PROG``."""
    return cat(trim(sess), " ", col(yr), " ", trim(prog))


def school_code(yr, sess, crs_no, sec_no, cat_, prog) -> Column:
    """``yr;sess;crs_no;sec_no;cat;prog`` (section school code, coursekey)."""
    return cat(school_code_head(yr, sess), school_code_tail(crs_no, sec_no, cat_, prog))


def school_code_head(yr, sess) -> Column:
    """``yr;sess``: the part of a section school code that its meeting gives."""
    return cat(col(yr), ";", trim(sess))


def school_code_tail(crs_no, sec_no, cat_, prog) -> Column:
    """``;crs_no;sec_no;cat;prog``: the part that its section gives."""
    return cat(";", trim(crs_no), ";", trim(sec_no), ";", trim(cat_), ";", trim(prog))


def section_code(crs_no, sec_no, sess, yr, prog) -> Column:
    """``crs_no-sec_no SS YYYY PROG`` built from section parts."""
    return cat(trim(crs_no), "-", trim(sec_no), " ", trim(sess), " ", col(yr), " ", trim(prog))


def section_code_of_course(course_code_, sec, term_code_) -> Column:
    """``left(course_code, 8)-sec term_code``: the same code from a course code."""
    return cat(left(course_code_, 8), "-", trim(sec), " ", trim(term_code_))


def term_sess(term_code_) -> Column:
    """Session slice of a term code (first 2)."""
    return left(term_code_, 2)


def term_year(term_code_) -> Column:
    """Year slice of a term code (4 from position 4)."""
    return substr(term_code_, 4, 4)


def term_program(term_code_) -> Column:
    """Programme slice of a term code (last 4 after trimming)."""
    return right(trim(term_code_), 4)


def key_year(coursekey) -> Column:
    """Year slice of a section school code (first 4)."""
    return left(coursekey, 4)


def course_title(t1, t2, t3) -> Column:
    return cat(trim(t1), " ", trim(t2), " ", trim(t3))


# --- numbers -----------------------------------------------------------------

def whole(c) -> Column:
    """CAST(x AS INT) of a clock time such as 900.0."""
    return col(c).cast("int")


def credits_text(hrs) -> Column:
    """Credit hours with two decimals, e.g. ``3.00``."""
    return col(hrs).cast("decimal(4,2)").cast("string")


def to_number(c) -> Column:
    """A numeric id held as text; null stays null, text that is no whole number
    fails the query (a silent null would drop or misname the person)."""
    text = trim(c)
    number = text.try_cast("bigint")
    return (F.when(text.isNull() | number.isNotNull(), number)
             .otherwise(F.raise_error(F.concat(F.lit("not a numeric id: "), text)).cast("bigint")))


def is_number(c) -> Column:
    """Whether ``to_number`` takes it: null, or text of a whole number."""
    text = trim(c)
    return text.isNull() | text.try_cast("bigint").isNotNull()


def id_text(c) -> Column:
    """An id as whole-number text, null as ``0`` (CSV export of ids)."""
    return nvl(col(c), 0).cast("bigint").cast("string")


# --- meetings and locations --------------------------------------------------

def meeting_slot(days, beg_tm, end_tm) -> Column:
    """``days beg-end``; ``------- 0-0`` without days or times."""
    return nvl(cat(trim(days), " ", whole(beg_tm), "-", whole(end_tm)), V.NO_MEETING)


def meeting_text(crs_no, sec_no, days, beg_tm, end_tm) -> Column:
    """``crs_no-sec_no-days beg-end``; ``------- 0-0`` without days or times."""
    return cat(trim(crs_no), "-", col(sec_no), "-", meeting_slot(days, beg_tm, end_tm))


def merge_pattern(x, y) -> Column:
    """One meeting text if both extremes agree, else ``x / y``.

    Null when there is no meeting: the compare is unknown and the second arm
    concatenates nulls.
    """
    return F.when(trim(x) == trim(y), col(x)).otherwise(cat(col(x), " / ", col(y)))


def location(bldg, room) -> Column:
    """``building room``, or ``TBA`` when either is missing."""
    return nvl(cat(trim(bldg), " ", trim(room)), V.NO_LOCATION)


# --- people ------------------------------------------------------------------

def status_priority(status_code) -> Column:
    """Rank of a status (lower wins), first match in list order, else 99."""
    c = col(status_code)
    expr = None
    for code, rank in V.STATUS_PRIORITY:
        expr = F.when(c == code, rank) if expr is None else expr.when(c == code, rank)
    return expr.otherwise(V.OTHER_STATUS_PRIORITY)


def user_role(hrpay, tle) -> Column:
    """FAC when the first job's pay code is not a non-faculty one, or tle = 'Y'.

    Three-valued: a null pay code is neither in nor out of the list, so it
    makes faculty only together with tle = 'Y'.
    """
    fac = (~col(hrpay).isin(*V.NON_FACULTY_PAY)) | (col(tle) == V.TLE_FLAG)
    return F.when(fac, F.lit(V.FACULTY_ROLE)).otherwise(F.lit(V.STUDENT_ROLE))


def _titled(c) -> Column:
    """True unless the title is missing or the sentinel 'x' (blank-insensitive)."""
    return F.rtrim(nvl(col(c), V.NO_TITLE)) != V.NO_TITLE


def position_text(title1, title2, title3) -> Column:
    """``title1; title2; title3`` with missing titles left out.

    Title 1 is trimmed, titles 2 and 3 are not; a missing title 1 leaves the
    text starting with ``; ``.
    """
    p1 = F.when(_titled(title1), trim(title1)).otherwise(F.lit(""))
    p2 = F.when(_titled(title2), cat("; ", col(title2))).otherwise(F.lit(""))
    p3 = F.when(_titled(title3), cat("; ", col(title3))).otherwise(F.lit(""))
    return F.concat(p1, p2, p3)
