"""Registered queries: one per operator group of the feeds.

Each entry takes (spark, sf_dir), derives the registrar tables from the test
data in ``sf_dir`` and returns a lazy DataFrame at the fixture clock.  The
matching DuckDB SQL is in ``registrar_feeds.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from registrar_feeds import fixed_values as V
from registrar_feeds.asof import FIXTURE_AS_OF, FIXTURE_AS_OF_CLOSED
from registrar_feeds.functions import codes as C
from registrar_feeds.operators import crosslist as X
from registrar_feeds.operators import filters as Fl
from registrar_feeds.operators import people as P
from registrar_feeds.operators import sections as S
from registrar_feeds.operators.audit import status_transitions
from registrar_feeds.plans import feeds as FD
from registrar_feeds.plans.runner import run_feeds
from registrar_feeds.session import remove, scratch_dir
from registrar_feeds.sinks import csv_export as CSV
from registrar_feeds.sinks.digest import digest_lines
from registrar_feeds.sinks.ordered import with_position
from registrar_feeds.sources import fixture_tables, read_tables, store_tables, table_name, write_tables

#: A key of each table, for counting what was written and read back.
STAGED_KEYS = {
    "jenzcrs_rec": "coursekey", "crs_rec": "crs_no", "jenzccd_rec": "course_code", "jenztrm_rec": "term_code",
    "jenzdpt_rec": "dept_code", "jenzsch_rec": "course_code", "secmtg_rec": "mtg_no", "sec_rec": "crs_no",
    "id_rec": "id", "sess_table": "sess", "mtg_rec": "mtg_no", "bldg_table": "bldg", "dept_table": "dept",
    "jenzcst_rec": "host_id", "jenzprs_rec": "host_id", "job_rec": "id", "prog_enr_rec": "id",
    "addree_rec": "prim_id", "role_rec": "id", "jenzcrp_rec": "host_id", "audit_sec_rec": "audit_timestamp",
}

A = FIXTURE_AS_OF
SCHOOL = V.DEFAULT_SCHOOL

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def query(name: str, keep_sections: bool = False, staged: str | None = None):
    """Register a query; with ``keep_sections`` the sections its tables derive from
    are joined once and kept for the query (it reads several of these tables).
    With ``staged``, an environment, it gets all tables written there and read back
    by the reader, and their folder; the sections are kept until they are written."""
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            sections = scratch_dir(spark, "sections") if keep_sections or staged else None
            t = fixture_tables(spark, sf_dir, sections)
            if staged:
                base = scratch_dir(spark, "staged")
                write_tables(t, base, staged)
                remove(spark, sections)
                return fn(spark, read_tables(spark, base, staged.upper(), names=tuple(t)), base)
            return fn(spark, t)
        run.__name__ = name
        run.__doc__ = fn.__doc__
        _REGISTRY[name] = run
        return fn
    return deco


def registry() -> dict[str, Query]:
    return dict(_REGISTRY)


# --- feeds -------------------------------------------------------------------

@query("feed_courses", keep_sections=True)
def _feed_courses(spark, t):
    return FD.feed_courses(t, A, SCHOOL)


@query("feed_users")
def _feed_users(spark, t):
    return FD.feed_users(t, A, SCHOOL)


@query("feed_enrollment", keep_sections=True)
def _feed_enrollment(spark, t):
    return FD.feed_enrollment(t, A)


@query("feed_crosslist")
def _feed_crosslist(spark, t):
    return FD.feed_crosslist(t, A)


@query("feed_cancelled_courses")
def _feed_cancelled(spark, t):
    return FD.feed_cancelled_courses(t, A)


# --- cross-listing -------------------------------------------------------------

@query("meeting_window")
def _meeting_window(spark, t):
    return Fl.meeting_window(t["mtg_rec"], A).select("mtg_no", "yr", "sess", "beg_date", "end_date")


@query("shared_meeting_master")
def _shared_meeting_master(spark, t):
    return X.shared_meeting_master(t, A)


@query("crosslist_members")
def _crosslist_members(spark, t):
    return X.crosslist_members(t, X.shared_meeting_master(t, A))


@query("ordered_export")
def _ordered_export(spark, t):
    """CROSSLIST with each row's position in export order."""
    return with_position(FD.feed_crosslist(t, A))


# --- scalar helpers ------------------------------------------------------------

@query("code_formats")
def _code_formats(spark, t):
    s = t["sec_rec"]
    c = t["crs_rec"].select(F.col("crs_no").alias("c_crs_no"), F.col("cat").alias("c_cat"),
                            "prog", "title1", "title2", "title3")
    j = s.join(c, (F.col("c_crs_no") == F.col("crs_no")) & (F.col("c_cat") == F.col("cat")))
    return j.select(
        C.course_code("crs_no", "cat").alias("coursecode"),
        C.term_code("sess", "yr", "prog").alias("termcode"),
        C.school_code("yr", "sess", "crs_no", "sec_no", "cat", "prog").alias("schoolcode"),
        C.section_code("crs_no", "sec_no", "sess", "yr", "prog").alias("sectioncode"),
        C.course_title("title1", "title2", "title3").alias("coursetitle"))


@query("code_slicing")
def _code_slicing(spark, t):
    return t["jenzcrs_rec"].select(
        "course_code", "sec", "term_code",
        C.term_sess("term_code").alias("term_sess"), C.term_year("term_code").alias("term_year"),
        C.term_program("term_code").alias("term_program"), C.key_year("coursekey").alias("key_year"),
        C.section_code_of_course("course_code", "sec", "term_code").alias("sectioncode"))


@query("null_default")
def _null_default(spark, t):
    a = t["mtg_rec"]
    c = t["bldg_table"].select(F.col("bldg").alias("c_bldg"), "txt")
    j = a.join(c, F.col("c_bldg") == F.col("bldg"), "left")
    return j.select("mtg_no", "bldg", "room", C.location("txt", "room").alias("location"),
                    C.meeting_text(F.lit("C"), F.lit("01"), "days", "beg_tm", "end_tm").alias("meeting"))


@query("number_formats")
def _number_formats(spark, t):
    return t["sec_rec"].select("crs_no", "sec_no", "yr", "sess",
                               C.credits_text("hrs").alias("credits"),
                               C.id_text("fac_id").alias("fac_text"),
                               C.to_number(F.col("fac_id").cast("string")).alias("fac_number"))


@query("month_arithmetic")
def _month_arithmetic(spark, t):
    return t["jenztrm_rec"].select(
        "term_code", "start_date", "end_date",
        F.add_months("start_date", 6).alias("start_plus_6m"),
        F.add_months("end_date", -1).alias("end_minus_1m"),
        F.date_sub("end_date", 4).alias("end_minus_4d"),
        Fl.term_window_pred(A).alias("in_term_window"))


# --- audit and digest ------------------------------------------------------------

@query("status_transitions")
def _status_transitions(spark, t):
    return status_transitions(t["audit_sec_rec"], A)


@query("digest_cancelled")
def _digest(spark, t):
    return digest_lines(FD.cancelled_courses(t, A), A)


# --- section operators -------------------------------------------------------------

@query("term_window")
def _term_window(spark, t):
    return Fl.term_window(t["jenztrm_rec"], A).select("term_code", "start_date", "end_date")


@query("program_exclusion")
def _program_exclusion(spark, t):
    return t["jenzcrs_rec"].where(Fl.program_ok_by_term("term_code")).select("course_code", "sec", "term_code")


@query("recent_cancellations")
def _recent_cancellations(spark, t):
    return Fl.recent_cancellations(t["sec_rec"], A).select(
        "crs_no", "sec_no", "cat", "yr", "sess", "stat_date", "end_date")


@query("section_instructor")
def _section_instructor(spark, t):
    return S.section_instructor(t)


@query("built_key_join")
def _built_key_join(spark, t):
    cr = t["crs_rec"].select("crs_no", "cat", "dept", "course_key")
    jc = t["jenzcrs_rec"].select("course_code", "sec", "term_code", F.col("course_key").alias("j_course_key"))
    return (jc.join(cr, F.col("course_key") == F.col("j_course_key"))
              .select("course_code", "sec", "term_code", "crs_no", "cat", "dept"))


@query("meet_pattern")
def _meet_pattern(spark, t):
    return S.meet_pattern(t)


@query("active_sections", keep_sections=True)
def _active_sections(spark, t):
    return S.active_sections(t, A)


@query("cancelled_sections")
def _cancelled_sections(spark, t):
    return S.cancelled_sections(t, A)


@query("outer_multiplicity")
def _outer_multiplicity(spark, t):
    jc = t["jenzcrs_rec"].select("course_code", "sec", "term_code")
    sch = t["jenzsch_rec"].select(*[F.col(c).alias("s_" + c) for c in ("course_code", "sec", "term_code")])
    j = jc.join(sch, (F.col("s_term_code") == F.col("term_code")) & (F.col("s_sec") == F.col("sec"))
                & (F.col("s_course_code") == F.col("course_code")), "left")
    return j.select("course_code", "sec", "term_code", F.col("s_sec").isNotNull().alias("scheduled"))


# --- COURSES / ENROLLMENT ------------------------------------------------------------

@query("union_all_feeds", keep_sections=True)
def _union_all(spark, t):
    return FD.feed_enrollment(t, A).select("coursecode", "uniqueuserid", "enroll_status")


@query("enrollment_rejects", keep_sections=True)
def _enrollment_rejects(spark, t):
    """ENROLLMENT with every person id that ends in 7 spoilt: the feed without
    those enrolments, and the enrolments."""
    spoilt = F.when(F.col("host_id").endswith("7"), F.concat(F.lit("ID-"), "host_id")).otherwise(F.col("host_id"))
    t = {**t, "jenzcrp_rec": t["jenzcrp_rec"].withColumn("host_id", spoilt)}
    feed = FD.feed_enrollment(t, A, Observation("enrollment_rejects"))
    bad = FD.enrollment_rejects(t, A)
    return (feed.select(F.lit("feed").alias("part"), "coursecode", F.col("uniqueuserid").cast("string").alias("person"),
                        F.col("enrollmenttype").alias("kind"))
            .unionByName(bad.select(F.lit("reject").alias("part"), F.col("course_code").alias("coursecode"),
                                    F.col("host_id").alias("person"), F.col("status_code").alias("kind"))))


# --- USERS parts ---------------------------------------------------------------------

@query("primary_status")
def _primary_status(spark, t):
    return P.primary_status(P.eligible_people(t, A))


@query("position_title")
def _position_title(spark, t):
    ids = t["job_rec"].select("id").distinct()
    titles = P.position_titles(t, A).withColumnRenamed("id", "t_id")
    j = ids.join(titles, F.col("t_id") == F.col("id"), "left")
    return j.select("id", "title1", "title2", "title3",
                    C.position_text("title1", "title2", "title3").alias("position"))


@query("user_role")
def _user_role(spark, t):
    best = P.primary_status(P.eligible_people(t, A)).select("host_id")
    t1 = P.position_titles(t, A).select(F.col("id").alias("t1_id"), F.col("hrpay1").alias("hrpay"))
    tle = P.tle_holders(t).withColumnRenamed("id", "tle_id")
    j = (best.join(t1, F.col("t1_id") == F.col("host_id"), "left")
             .join(tle, F.col("tle_id") == F.col("host_id"), "left"))
    return j.select("host_id", "hrpay", "tle", C.user_role("hrpay", "tle").alias("role"))


@query("preff_exclusion")
def _preff_exclusion(spark, t):
    return P.preff_exclusion(t["jenzcst_rec"], "host_id", t["role_rec"], A)


@query("preff_exclusion_off")
def _preff_exclusion_off(spark, t):
    return P.preff_exclusion(t["jenzcst_rec"], "host_id", t["role_rec"], FIXTURE_AS_OF_CLOSED)


@query("distinct_users")
def _distinct_users(spark, t):
    return P.distinct_users(P.user_columns(P.person_rows(t, A), SCHOOL))


# --- sinks ---------------------------------------------------------------------------

def _round_trip(spark, feed: str, df: DataFrame) -> DataFrame:
    out = scratch_dir(spark, "export")
    paths = CSV.export_feed(feed, df, out)
    return CSV.read_csv(spark, feed, paths["export"])


@query("csv_courses", keep_sections=True)
def _csv_courses(spark, t):
    return _round_trip(spark, "COURSES", FD.feed_courses(t, A, SCHOOL))


@query("csv_users")
def _csv_users(spark, t):
    return _round_trip(spark, "USERS", FD.feed_users(t, A, SCHOOL))


@query("csv_enrollment", keep_sections=True)
def _csv_enrollment(spark, t):
    return _round_trip(spark, "ENROLLMENT", FD.feed_enrollment(t, A))


@query("csv_crosslist")
def _csv_crosslist(spark, t):
    return _round_trip(spark, "CROSSLIST", FD.feed_crosslist(t, A))


# --- staged tables, run, order ---------------------------------------------------------

@query("staged_tables", staged="train")
def _staged_tables(spark, t, base):
    """Rows and distinct keys of every table, written and read back (the audit
    trail from its own namespace)."""
    counts = [t[n].agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("n_rows"),
                       F.count_distinct(F.coalesce(F.col(k).cast("string"), F.lit("~"))).alias("n_keys"))
              for n, k in STAGED_KEYS.items()]
    return reduce(DataFrame.unionByName, counts)


@query("staged_transitions")
def _staged_transitions(spark, t):
    """Status transitions over the staged audit trail, read by its name in the catalog."""
    store_tables({"audit_sec_rec": t["audit_sec_rec"]}, scratch_dir(spark, "staged"), "train", audit_by="month")
    return status_transitions(spark.table(table_name("train", "audit_sec_rec")), A)


@query("ordered_users")
def _ordered_users(spark, t):
    """USERS with each row's position in export order."""
    return with_position(FD.feed_users(t, A, SCHOOL), "row_no").select(
        "row_no", "lastname", "firstname", "role", "uniqueid")


@query("ordered_cancelled")
def _ordered_cancelled(spark, t):
    """CANCELLED_COURSES with each row's position in digest order."""
    return with_position(FD.feed_cancelled_courses(t, A), "row_no").select(
        "row_no", "crs_no", "sec_no", "sess", "yr", "audit_timestamp")


@query("scheduled_run", staged="live")
def _scheduled_run(spark, t, base):
    """One scheduled run over the staged tables; its four exports and the
    digest read back, one text line per row, tagged by feed.  The staged tables
    go when no feed reads them any more."""
    out, arch, digest = (scratch_dir(spark, n) for n in ("export", "archive", "digest"))
    written = run_feeds(t, A, out, arch, digest, SCHOOL, tables_read=lambda: remove(spark, base))
    parts = []
    for feed in V.FEED_ORDER:
        df = CSV.read_csv(spark, feed, written[feed]["export"])
        parts.append(df.select(F.lit(feed).alias("feed"), F.concat_ws("|", *[
            F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in df.columns]).alias("line")))
    parts.append(spark.read.text(written["DIGEST"]["digest"]).select(F.lit("DIGEST").alias("feed"), F.col("value").alias("line")))
    return reduce(DataFrame.unionByName, parts)


@query("snapshot_archive", keep_sections=True)
def _snapshot_archive(spark, t):
    """ENROLLMENT exported and archived in one run; the archive read back."""
    out = scratch_dir(spark, "export")
    arch = scratch_dir(spark, "archive")
    paths = CSV.export_feed("ENROLLMENT", FD.feed_enrollment(t, A), out, arch, A.ts)
    return CSV.read_csv(spark, "ENROLLMENT", paths["archive"])
