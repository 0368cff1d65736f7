"""Edge cases on handmade rows (what the derived test data cannot show)."""

import datetime as dt

from pyspark.sql import functions as F

from registrar_feeds.asof import AsOf
from registrar_feeds.functions import codes as C
from registrar_feeds.functions import dates as Dt
from registrar_feeds.operators import filters as Fl
from registrar_feeds.operators import people as P
from registrar_feeds.operators import sections as S
from registrar_feeds.operators.audit import status_transitions
from registrar_feeds.plans import feeds as FD
from tests.helpers import D, TS, dec, tables

SEPT = AsOf(dt.datetime(2024, 9, 10, 14, 0))
JULY = AsOf(dt.datetime(2024, 7, 10, 14, 0))


def _sec(crs="ART 101", sec="01", yr="2024", sess="RA", subsess="S1", fac=7, stat="O",
         stat_date=D(2024, 9, 1), beg=D(2024, 9, 1), end=D(2024, 12, 20), cat="UG18"):
    return (crs, sec, cat, yr, sess, subsess, fac, dec(3), stat, stat_date, beg, end)


def test_padded_keys_join(spark):
    t = tables(spark,
               sec_rec=[_sec(stat="X", stat_date=D(2024, 9, 9))],
               crs_rec=[("ART 101 ", "UG18 ", "D1", "UNDG", "Art", "Intro", "Lecture")],
               id_rec=[(7, "Smith", "Ann", "", None)],
               sess_table=[("RA", "Fall")], dept_table=[("D1 ", "Art Dept")])
    rows = FD.enrollment_closed(t, SEPT).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.coursecode, r.uniqueuserid, r.enrollmenttype, r.gradeperiod, r.enroll_status) == \
        ("ART 101 (UG18)", 7, "1PR", "RA 2024 UNDG", "Closed")


def test_null_in_not_in_set_drops_everyone_in_season(spark):
    t = tables(spark, jenzcst_rec=[(1, "STU"), (2, "FAC")], role_rec=[(None, "PREFF", None)])
    assert P.preff_exclusion(t["jenzcst_rec"], "host_id", t["role_rec"], JULY).count() == 0
    assert P.preff_exclusion(t["jenzcst_rec"], "host_id", t["role_rec"], SEPT).count() == 2


def test_not_in_drops_listed_and_null_keys(spark):
    t = tables(spark, jenzcst_rec=[(1, "STU"), (2, "FAC"), (None, "STU")],
               role_rec=[(2, "PREFF", None), (1, "PREFF", D(2024, 1, 1)), (1, "OTHER", None)])
    got = sorted(r.host_id for r in P.preff_exclusion(t["jenzcst_rec"], "host_id", t["role_rec"], JULY).collect())
    assert got == [1]
    # empty set: every row kept, the null key too
    t2 = tables(spark, jenzcst_rec=[(1, "STU"), (None, "STU")], role_rec=[(1, "OTHER", None)])
    assert P.preff_exclusion(t2["jenzcst_rec"], "host_id", t2["role_rec"], JULY).count() == 2


def test_position_text_and_sentinel(spark):
    df = spark.createDataFrame(
        [("Dean", "x", "Chair"), (None, "A", None), ("x", None, None), (" Dean ", " B", None)],
        "t1 string, t2 string, t3 string")
    got = [r.p for r in df.select(C.position_text("t1", "t2", "t3").alias("p")).collect()]
    assert got == ["Dean; Chair", "; A", "", "Dean;  B"]


def test_three_meeting_texts_keep_extremes(spark):
    t = tables(spark,
               secmtg_rec=[("C1", "01", "UG", "2024", "RA", 5)],
               mtg_rec=[(5, "2024", "RA", "B1", "R1", d, dec(900), dec(950), D(2024, 9, 1), D(2024, 12, 1))
                        for d in ("M", "T", "W")],
               bldg_table=[("B1", "Hall")])
    mp = S.meet_pattern(t).collect()
    assert len(mp) == 1
    m = mp[0]
    assert (m.x, m.y, m.bldg, m.room) == ("C1-01-W 900-950", "C1-01-M 900-950", "Hall", "R1")
    merged = S.meet_pattern(t).select(C.merge_pattern("x", "y").alias("m")).first().m
    assert merged == "C1-01-W 900-950 / C1-01-M 900-950"


def test_null_time_and_missing_room(spark):
    df = spark.createDataFrame([("C1", "01", "M", None, dec(950), "B", None)],
                               "crs string, sec string, days string, beg decimal(8,2), end decimal(8,2), "
                               "bldg string, room string")
    r = df.select(C.meeting_text("crs", "sec", "days", "beg", "end").alias("t"),
                  C.location("bldg", "room").alias("l")).first()
    assert r.t == "C1-01-" + "------- 0-0" and r.l == "TBA"


def test_equal_extremes_print_once_and_no_meeting_is_null(spark):
    df = spark.createDataFrame([("a ", "a"), (None, None)], "x string, y string")
    assert [r.m for r in df.select(C.merge_pattern("x", "y").alias("m")).collect()] == ["a ", None]


def test_job_ending_today_is_ignored(spark):
    t = tables(spark, job_rec=[(1, 1, SEPT.today, "Dean", "FVT"), (2, 1, SEPT.today + dt.timedelta(days=1), "Dean", "FVT"),
                               (3, 1, None, "Dean", "FVT"), (4, 1, None, None, "FVT"), (5, 2, None, "Dean", "FVT")])
    assert sorted(r.id for r in Fl.open_titles(t["job_rec"], 1, SEPT).collect()) == [2, 3]


def test_status_priority_and_ties_are_repeatable(spark):
    rows = [(1, "ZZZ"), (1, "AAA"), (1, "QQQ"), (2, "STF"), (2, "FAC"), (3, "GLL"), (3, "STU")]
    df = spark.createDataFrame(rows, "host_id long, status_code string")
    for seed in (1, 2, 3):
        got = {r.host_id: (r.status_code, r.priority)
               for r in P.primary_status(df.orderBy(F.rand(seed)).repartition(3)).collect()}
        assert got == {1: ("AAA", 99), 2: ("FAC", 1), 3: ("GLL", 4)}


def test_user_role_three_valued(spark):
    df = spark.createDataFrame([(None, "Y"), (None, None), ("VEN", None), ("FVT", None), ("VEN", "Y")],
                               "hrpay string, tle string")
    got = [r.role for r in df.select(C.user_role("hrpay", "tle").alias("role")).collect()]
    assert got == ["FAC", "STU", "STU", "FAC", "FAC"]


def test_equal_people_without_contact_merge(spark):
    t = tables(spark, jenzcst_rec=[(1, "STU"), (2, "STU")],
               id_rec=[(1, "Doe", "Jo", "", None), (2, "Doe", "Jo", "", None)])
    rows = FD.feed_users(t, SEPT).collect()
    assert len(rows) == 1 and rows[0].uniqueid is None and rows[0].role == "STU"


def test_users_one_row_per_person_with_fanout(spark):
    t = tables(spark, jenzcst_rec=[(1, "STU"), (1, "FAC"), (1, "STF")],
               id_rec=[(1, "Doe", "Jo", "M", None)],
               jenzprs_rec=[(1, "jdoe", "jo@x.edu"), (1, "adoe", "a@x.edu")],
               job_rec=[(1, 1, None, "Prof", "VEN"), (1, 1, None, "Dean", "VEN"), (1, 2, None, "Chair", None),
                        (1, 3, None, "x", None), (1, 4, None, "Extra", None)],
               prog_enr_rec=[(1, "GOOD", "Y")], addree_rec=[(1, "N", "Jojo"), (1, "M", "Other")])
    rows = FD.feed_users(t, SEPT).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.username, r.email, r.uniqueid, r.lms_id) == ("adoe", "a@x.edu", "1", "1")
    assert (r.role, r.position, r.preferred_first_name) == ("FAC", "Dean; Chair", "Jojo")


def test_same_section_in_two_years_repeats_enrolment(spark):
    t = tables(spark,
               jenzcrs_rec=[("ART 101 (UG18)", "01", "RA 2024 UNDG", "2024;RA;ART 101;01;UG18;UNDG", "3.00")],
               jenzcrp_rec=[("ART 101 (UG18)", "01", "RA 2024 UNDG", " 42 ", "STU")],
               jenztrm_rec=[("RA 2024 UNDG", D(2024, 9, 1), D(2024, 12, 20))],
               sec_rec=[_sec(yr="2023", subsess="S1"), _sec(yr="2024", subsess="S2")])
    rows = FD.enrollment_open(t, SEPT).collect()
    assert sorted(r.gradeperiod for r in rows) == ["RA 2024 UNDG S1", "RA 2024 UNDG S2"]
    assert {r.uniqueuserid for r in rows} == {42}


def test_status_transitions_undirected_and_strict_window(spark):
    ts = TS(2024, 9, 10, 8, 0)
    key = ("ART 101", "01", "UG18", "2024", "RA", 7, D(2024, 9, 1), D(2024, 12, 20))

    def img(stat, when):
        return key + (stat, D(2024, 9, 10), D(2024, 9, 10), when)
    yday = TS(2024, 9, 9, 0, 0)
    t = tables(spark, audit_sec_rec=[img("X", ts), img("O", ts),             # cancelled or reopened
                                     img("O", TS(2024, 9, 10, 9)), img("C", TS(2024, 9, 10, 9)),
                                     img("X", yday), img("O", yday),         # exactly yesterday 00:00
                                     img("X", yday + dt.timedelta(seconds=1)), img("O", yday + dt.timedelta(seconds=1))])
    rows = status_transitions(t["audit_sec_rec"], SEPT).collect()
    assert sorted((r.oldstat, r.newstat, r.audit_timestamp) for r in rows) == [
        ("O", "X", yday + dt.timedelta(seconds=1)), ("O", "X", ts)]


def test_recent_cancellation_is_strict(spark):
    t = tables(spark, sec_rec=[_sec(sec="01", stat="X", stat_date=D(2024, 9, 6)),
                               _sec(sec="02", stat="X", stat_date=D(2024, 9, 7)),
                               _sec(sec="03", stat="X", stat_date=D(2024, 9, 7), end=SEPT.today),
                               _sec(sec="04", stat="O", stat_date=D(2024, 9, 9))])
    assert [r.sec_no for r in Fl.recent_cancellations(t["sec_rec"], SEPT).collect()] == ["02"]


def test_term_window_bounds_inclusive(spark):
    t = tables(spark, jenztrm_rec=[("A", D(2025, 3, 10), D(2025, 5, 1)), ("B", D(2025, 3, 11), D(2025, 5, 1)),
                                   ("C", D(2024, 1, 1), D(2024, 8, 10)), ("D", D(2024, 1, 1), D(2024, 8, 9))])
    assert sorted(r.term_code for r in Fl.term_window(t["jenztrm_rec"], SEPT).collect()) == ["A", "C"]


def test_month_end_clamp(spark):
    a = AsOf(dt.datetime(2024, 8, 31, 10, 0))
    r = spark.range(1).select(Dt.months_from_today(a, 6).alias("p"), Dt.months_from_today(a, -1).alias("m")).first()
    assert (r.p, r.m) == (D(2025, 2, 28), D(2024, 7, 31))


def _cl_tables(spark, secs):
    mtg = [(5, "2024", "RA", "B1", "R1", "M", dec(900), dec(950), D(2024, 9, 1), D(2024, 12, 1))]
    return tables(spark, secmtg_rec=[(c, s, "UG", "2024", "RA", 5) for c, s in secs], mtg_rec=mtg,
                  crs_rec=[(c, "UG", "D1", "UNDG", "t", "t", "t") for c in {c for c, _ in secs}])


def test_crosslist_single_section_meeting_has_no_row(spark):
    assert FD.feed_crosslist(_cl_tables(spark, [("C1", "01")]), SEPT).count() == 0


def test_crosslist_master_is_greatest_code(spark):
    rows = FD.feed_crosslist(_cl_tables(spark, [("C1", "01"), ("C2", "01"), ("C1", "02")]), SEPT).collect()
    assert {r.targ_code for r in rows} == {"2024;RA;C2;01;UG;UNDG"}
    assert [r.crls_code for r in rows] == ["2024;RA;C1;01;UG;UNDG", "2024;RA;C1;02;UG;UNDG"]


def test_bad_ids_fail_instead_of_turning_null(spark):
    import pytest
    from pyspark.errors import PySparkException
    good = spark.createDataFrame([(" 12 ",), (None,)], "h string").select(C.to_number("h").alias("n")).collect()
    assert [r.n for r in good] == [12, None]
    with pytest.raises(PySparkException, match="not a numeric id: 12a"):
        spark.createDataFrame([("12a",)], "h string").select(C.to_number("h")).collect()


def test_long_course_code_is_cut_in_section_codes(spark):
    df = spark.createDataFrame([("LONGCODE9 (UG)", "01 ", "RA 2024 UNDG")], "c string, s string, t string")
    assert df.select(C.section_code_of_course("c", "s", "t").alias("x")).first().x == "LONGCODE-01 RA 2024 UNDG"
