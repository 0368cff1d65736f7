"""The five feeds.

Each feed is ``feed(tables, as_of, ...) -> DataFrame``: a lazy plan over the
staged registrar tables and an explicit run clock.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from registrar_feeds import fixed_values as V
from registrar_feeds.asof import AsOf
from registrar_feeds.functions import codes as C
from registrar_feeds.operators import crosslist as X
from registrar_feeds.operators import filters as Fl
from registrar_feeds.operators import people as P
from registrar_feeds.operators import sections as S
from registrar_feeds.operators.audit import status_transitions
from registrar_feeds.operators.joins import prefixed
from registrar_feeds.operators.sets import union_all_by_position

USERS_COLUMNS = ("firstname", "preferred_first_name", "middlename", "lastname", "name_prefix",
                 "username", "email", "uniqueid", "role", "school", "lms_id", "position", "pwd",
                 "gender", "gradyr", "additional_schools")
CANCELLED_COLUMNS = ("crs_no", "sec_no", "sess", "yr", "title", "beg_date", "end_date", "stat",
                     "stat_date", "schd_upd_date", "oldstat", "newstat", "audit_timestamp")


def _meet_pattern_p(t) -> DataFrame:
    """The meeting pattern (``sections.meet_pattern``) as both arms of COURSES join
    it: with slots for the texts, which ``_with_texts`` makes of the joined rows."""
    mp = S.section_slots(t)
    return mp.select(*[F.col(c).alias("mp_" + c) for c in ("crs_no", "yr", "mtg_no", "sec_no", "bldg", "room")],
                     "max_slot", "min_slot")


def _with_texts(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"x": S.meeting_text("max_slot", "mp_"), "y": S.meeting_text("min_slot", "mp_")})


def courses_active(t: dict[str, DataFrame], as_of: AsOf, school: str,
                   mp: DataFrame | None = None) -> DataFrame:
    """COURSES, first arm: one row per active section meeting."""
    a = S.join_instructor(S.active_sections(t, as_of), t)
    st = t["sess_table"].select(F.col("sess").alias("st_sess"), F.col("txt").alias("sess_txt"))
    mp = _meet_pattern_p(t) if mp is None else mp
    j = (a.join(st, F.col("st_sess") == F.col("sess"))
          .join(mp, (F.col("mp_crs_no") == F.col("crs_no")) & (F.col("mp_yr") == C.key_year("coursekey"))
                & (F.col("mp_mtg_no") == F.col("mtg_no")), "left"))
    mt = C.merge_pattern("x", "y")
    return _with_texts(j).select(
        C.trim("title").alias("coursename"),
        C.trim("dept_descr").alias("department"),
        C.trim("course_code").alias("coursecode"),
        F.col("hrs").alias("credits"),
        C.cat(C.trim("title"), "-", C.trim("sec"), " ", C.trim("sess_txt"), " ", F.col("yr"), " ", mt).alias("descr"),
        C.cat(C.trim("sec"), "-", C.trim("i_instr_name"), " ", C.trim("sess_txt"), " ", F.col("yr"), " ", mt)
         .alias("sectionname"),
        C.trim("coursekey").alias("secschoolcode"),
        C.section_code_of_course("course_code", "sec", "term_code").alias("sectioncode"),
        mt.alias("secdescr"),
        C.location("mp_bldg", "mp_room").alias("location"),
        F.lit(school).alias("school"),
        C.cat(C.trim("term_code"), " ", F.col("i_subsess")).alias("gradingperiod"),
        F.lit(V.ACTIVE).alias("sec_status"),
    )


def courses_cancelled(t: dict[str, DataFrame], as_of: AsOf, school: str,
                      mp: DataFrame | None = None) -> DataFrame:
    """COURSES, second arm: recently cancelled sections, per section meeting."""
    c = S.cancelled_sections(t, as_of)
    # same projection as in active_sections, so the planner can reuse one exchange
    sm = prefixed(t["secmtg_rec"], "m_")
    mp = _meet_pattern_p(t) if mp is None else mp
    j = (c.join(sm, (F.col("m_crs_no") == F.col("crs_no")) & (F.col("m_sec_no") == F.col("sec_no"))
                & (C.trim("m_sess") == F.col("sess")) & (F.col("m_yr") == F.col("yr"))
                & (F.col("m_cat") == F.col("cat")))
          .join(mp, (F.col("mp_crs_no") == F.col("crs_no")) & (F.col("mp_yr") == F.col("yr"))
                & (F.col("mp_mtg_no") == F.col("m_mtg_no")), "left"))
    title = C.course_title("title1", "title2", "title3")
    mt = C.merge_pattern("x", "y")
    return _with_texts(j).select(
        title.alias("coursename"),
        C.trim("dept_txt").alias("department"),
        C.course_code("crs_no", "cat").alias("coursecode"),
        C.credits_text("hrs").alias("credits"),
        C.cat(C.trim(title), "-", C.trim("sec_no"), " ", C.trim("sess_txt"), " ", F.col("yr"), " ", mt).alias("descr"),
        C.cat(C.trim("sec_no"), "-", C.trim("instr_name"), " ", C.trim("sess_txt"), " ", F.col("yr"), " ", mt)
         .alias("sectionname"),
        C.school_code("yr", "sess", "crs_no", "sec_no", "cat", "prog").alias("secschoolcode"),
        C.section_code("crs_no", "sec_no", "sess", "yr", "prog").alias("sectioncode"),
        mt.alias("secdescr"),
        C.location("mp_bldg", "mp_room").alias("location"),
        F.lit(school).alias("school"),
        C.term_code("sess", "yr", "prog").alias("gradingperiod"),
        F.lit(V.CANCELLED).alias("sec_status"),
    )


def feed_courses(t: dict[str, DataFrame], as_of: AsOf, school: str = V.DEFAULT_SCHOOL) -> DataFrame:
    """COURSES: active section meetings UNION ALL recently cancelled ones.

    Section history is cut to the years at hand first; the meeting pattern is
    one DataFrame joined by both arms.
    """
    t = S.recent_history(t, as_of)
    mp = _meet_pattern_p(t)
    return union_all_by_position(courses_active(t, as_of, school, mp),
                                 courses_cancelled(t, as_of, school, mp))


def feed_users(t: dict[str, DataFrame], as_of: AsOf, school: str = V.DEFAULT_SCHOOL) -> DataFrame:
    """USERS: one row per eligible person, equal rows merged, sorted by
    last name, first name, role (the remaining columns make the order total)."""
    users = P.distinct_users(P.user_columns(P.person_rows(t, as_of), school))
    return users.orderBy(*[F.col(c).asc_nulls_first() for c in
                           ("lastname", "firstname", "role") + tuple(c for c in USERS_COLUMNS
                                                                     if c not in ("lastname", "firstname", "role"))])


def _enrolments_at_hand(t: dict[str, DataFrame], as_of: AsOf) -> DataFrame:
    trm = Fl.term_window(t["jenztrm_rec"], as_of)
    return t["jenzcrp_rec"].where(Fl.in_list("term_code", trm, "term_code")).where(Fl.program_ok_by_term("term_code"))


def enrollment_rejects(t: dict[str, DataFrame], as_of: AsOf) -> DataFrame:
    """Enrolments of current terms whose person id is no whole number, as they
    are in the table."""
    return _enrolments_at_hand(t, as_of).where(~C.is_number("host_id")).select(
        "course_code", "sec", "term_code", "host_id", "status_code")


def enrollment_open(t: dict[str, DataFrame], as_of: AsOf, rejected: Observation | None = None) -> DataFrame:
    """ENROLLMENT, first arm: enrolments in offered sections of current terms.

    Enrolments and offerings are cut to the in-window terms first, by a list of
    term codes read when the plan runs (``filters.in_list``), so that only those
    terms' folders are opened; enrolments then by NOT IN.  The
    section master is joined without the year, so a section repeats for each
    year it was taught (kept: it is the feed's multiplicity).

    A person id that is no whole number fails the query; with ``rejected`` such
    enrolments are left out (``enrollment_rejects`` has them) and counted there
    as ``n_rejects``, of ``n_rows``, when the feed runs.
    """
    trm = Fl.term_window(t["jenztrm_rec"], as_of).select(F.col("term_code").alias("t_term_code"), "start_date")
    at_hand = Fl.in_list("term_code", trm, "t_term_code")
    crp = _enrolments_at_hand(t, as_of)
    if rejected is not None:
        ok = C.is_number("host_id")
        crp = crp.observe(rejected, F.count_if(~ok).alias("n_rejects"), F.count(F.lit(1)).alias("n_rows")).where(ok)
    crp = crp.withColumn("uid", C.to_number("host_id"))
    crp = P.preff_exclusion(crp, "uid", t["role_rec"], as_of)
    crp = crp.select(F.col("course_code").alias("e_course_code"), F.col("sec").alias("e_sec"),
                     F.col("term_code").alias("e_term_code"), "uid", F.col("status_code").alias("e_status"))
    crs = t["jenzcrs_rec"].where(at_hand)
    sr = t["sec_rec"].select(F.col("course_key").alias("s_course_key"), F.col("sec_no").alias("s_sec_no"),
                             C.trim("sess").alias("s_sess"), F.col("subsess").alias("s_subsess"))
    j = (crs.join(trm, F.col("t_term_code") == F.col("term_code"))
            .join(crp, (F.col("e_course_code") == F.col("course_code")) & (F.col("e_sec") == F.col("sec"))
                  & (F.col("e_term_code") == F.col("term_code")))
            .join(sr, (F.col("s_sec_no") == F.col("sec")) & (F.col("s_course_key") == F.col("course_key"))
                  & (F.col("s_sess") == F.col("term_sess"))))
    return j.select(
        C.trim("course_code").alias("coursecode"),
        C.section_code_of_course("course_code", "sec", "term_code").alias("sectioncode"),
        C.trim("coursekey").alias("secschoolcode"),
        F.col("uid").alias("uniqueuserid"),
        C.trim("e_status").alias("enrollmenttype"),
        C.cat(C.trim("term_code"), " ", C.trim("s_subsess")).alias("gradeperiod"),
        F.col("start_date"),
        F.lit(V.OPEN).alias("enroll_status"),
    )


def enrollment_closed(t: dict[str, DataFrame], as_of: AsOf) -> DataFrame:
    """ENROLLMENT, second arm: instructors of recently cancelled sections."""
    c = S.cancelled_sections(t, as_of)
    return c.select(
        C.course_code("crs_no", "cat").alias("coursecode"),
        C.section_code("crs_no", "sec_no", "sess", "yr", "prog").alias("sectioncode"),
        C.school_code("yr", "sess", "crs_no", "sec_no", "cat", "prog").alias("secschoolcode"),
        F.col("fac_id").alias("uniqueuserid"),
        F.lit(V.INSTRUCTOR_ENROLLMENT).alias("enrollmenttype"),
        C.term_code("sess", "yr", "prog").alias("gradeperiod"),
        F.col("beg_date").alias("start_date"),
        F.lit(V.CLOSED).alias("enroll_status"),
    )


def feed_enrollment(t: dict[str, DataFrame], as_of: AsOf, rejected: Observation | None = None) -> DataFrame:
    """ENROLLMENT: open enrolments UNION ALL closed instructor rows; ``rejected``
    as in ``enrollment_open``."""
    return union_all_by_position(enrollment_open(t, as_of, rejected), enrollment_closed(t, as_of))


def feed_crosslist(t: dict[str, DataFrame], as_of: AsOf) -> DataFrame:
    """CROSSLIST: (meeting, member code, master code), by meeting number
    (then member code, so the order is total)."""
    out = X.crosslist_members(t, X.shared_meeting_master(t, as_of))
    return out.orderBy("mtg_no", "crls_code")


def cancelled_courses(t: dict[str, DataFrame], as_of: AsOf) -> DataFrame:
    """CANCELLED_COURSES rows, unordered: recent status changes to or from
    cancelled, with the course title."""
    tr = status_transitions(t["audit_sec_rec"], as_of)
    ir = t["id_rec"].select(F.col("id").alias("i_id"))
    cr = t["crs_rec"].select(F.col("crs_no").alias("r_crs_no"), F.col("cat").alias("r_cat"),
                             "title1", "title2", "title3")
    j = (tr.join(ir, F.col("i_id") == F.col("fac_id"))
           .join(cr, (F.col("r_crs_no") == F.col("crs_no")) & (F.col("r_cat") == F.col("cat"))))
    return j.select("crs_no", "sec_no", "sess", "yr",
                    C.course_title("title1", "title2", "title3").alias("title"),
                    "beg_date", "end_date", "stat", "stat_date", "schd_upd_date", "oldstat", "newstat",
                    "audit_timestamp")


def feed_cancelled_courses(t: dict[str, DataFrame], as_of: AsOf) -> DataFrame:
    """CANCELLED_COURSES by course and section number (then the remaining
    columns, so the order is total)."""
    return cancelled_courses(t, as_of).orderBy(*[F.col(c).asc_nulls_first() for c in CANCELLED_COLUMNS])
