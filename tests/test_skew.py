"""One key holding a third of all rows: results stay whole and right, and the
hot group is reduced map-side before any shuffle."""

import contextlib
import datetime as dt
import io

from registrar_feeds.asof import FIXTURE_AS_OF, AsOf
from registrar_feeds.plans import feeds as FD
from tests.helpers import D, dec, tables

SEPT = AsOf(dt.datetime(2024, 9, 10, 14, 0))


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_hot_meeting_crosslist(spark):
    hot = [(f"C{i:04d}", "01", "UG", "2024", "RA", 1) for i in range(300)]
    rest = [(f"D{i:04d}", f"0{i % 3 + 1}", "UG", "2024", "RA", 2 + i // 3) for i in range(600)]
    mtg = [(m, "2024", "RA", "B1", "R1", "M", dec(900), dec(950), D(2024, 9, 1), D(2024, 12, 1))
           for m in range(1, 202)]
    crs = [(c, "UG", "D1", "UNDG", "t", "t", "t") for c in {r[0] for r in hot + rest}]
    t = tables(spark, secmtg_rec=hot + rest, mtg_rec=mtg, crs_rec=crs)
    df = FD.feed_crosslist(t, SEPT)
    got = sorted((r.mtg_no, r.crls_code, r.targ_code) for r in df.collect())

    # brute force
    by_mtg = {}
    for c, s, cat, yr, sess, m in hot + rest:
        by_mtg.setdefault(m, []).append(f"{yr};{sess};{c};{s};{cat};UNDG")
    want = sorted((m, code, max(codes)) for m, codes in by_mtg.items() if len(codes) > 1
                  for code in codes if code != max(codes))
    assert got == want and len(got) == 299 + 400


def test_hot_meeting_is_reduced_before_the_meeting_join(spark, smoke_tables):
    """Broadcasts off: over the section rows there is an exchange between the
    partial and the final aggregate, and the meetings come after it."""
    with _no_broadcast(spark):
        plan = _plan(FD.X.shared_meeting_master(smoke_tables, FIXTURE_AS_OF))
    lines = plan.splitlines()
    final = next(i for i, x in enumerate(lines) if "functions=[count(mtg_no" in x)
    partial = next(i for i, x in enumerate(lines) if "functions=[partial_count(mtg_no" in x)
    between = [x for x in lines[final + 1:partial] if x.strip()]
    assert any("Exchange hashpartitioning(mtg_no" in x for x in between)
    assert not any("Join" in x for x in between)
    assert any("SortMergeJoin" in x for x in lines[:final])


@contextlib.contextmanager
def _no_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def _hot_term(spark, n=400):
    """One section holds most meetings and enrolments of one current term."""
    code, term = "C1 (UG)", "RA 2024 UNDG"
    return tables(
        spark,
        jenzcrs_rec=[(code, "01", term, "2024;RA;C1;01;UG;UNDG", "3"), ("C2 (UG)", "01", term, "2024;RA;C2;01;UG;UNDG", "3")],
        crs_rec=[(c, "UG", "D1", "UNDG", "a", "b", "c") for c in ("C1", "C2")],
        jenzccd_rec=[("C1 (UG)", "One", "D1"), ("C2 (UG)", "Two", "D1")],
        jenztrm_rec=[(term, D(2024, 9, 1), D(2024, 12, 1))], sess_table=[("RA", "Fall")], id_rec=[(7, "L", "F", "", None)],
        sec_rec=[(c, "01", "UG", "2024", "RA", "S1", 7, dec(3), "O", D(2024, 1, 1), D(2024, 9, 1), D(2024, 12, 1)) for c in ("C1", "C2")],
        secmtg_rec=[("C1", "01", "UG", "2024", "RA", m) for m in range(n)] + [("C2", "01", "UG", "2024", "RA", n)],
        mtg_rec=[(m, "2024", "RA", "B1", "R1", "M", dec(900), dec(950), D(2024, 9, 1), D(2024, 12, 1)) for m in range(n + 1)],
        jenzcrp_rec=[(code, "01", term, str(i), "STU") for i in range(n)] + [("C2 (UG)", "01", term, "1", "STU")])


def test_hot_section_courses_and_enrollment(spark):
    """Shuffled joins: the hot section's rows are whole, once each."""
    t = _hot_term(spark)
    with _no_broadcast(spark):
        courses = FD.feed_courses(t, SEPT)
        got = courses.groupBy("coursecode").count().collect()
        assert {r["coursecode"]: r["count"] for r in got} == {"C1 (UG)": 400, "C2 (UG)": 1}
        enrolled = FD.feed_enrollment(t, SEPT)
        rows = enrolled.collect()
        assert sorted(r.uniqueuserid for r in rows if r.coursecode == "C1 (UG)") == list(range(400)) and len(rows) == 401
        assert "SortMergeJoin" in _plan(courses) and "SortMergeJoin" in _plan(enrolled)


def test_hot_person_users(spark):
    n = 900
    statuses = [(1, "STU")] * n + [(1, "FAC")] + [(i, "STU") for i in range(2, 2 + n)]
    jobs = [(1, 1 + k % 3, None, f"T{k:04d}", None if k % 2 else "VEN") for k in range(n)]
    people = [(i, f"L{i}", f"F{i}", "", None) for i in range(1, 2 + n)]
    t = tables(spark, jenzcst_rec=statuses, job_rec=jobs, id_rec=people)
    df = FD.feed_users(t, SEPT)
    rows = df.collect()
    assert len(rows) == n + 1
    one = [r for r in rows if r.lastname == "L1"][0]
    # least title per rank: T0000 (rank 1, pay VEN), T0001 (rank 2), T0002 (rank 3)
    assert one.position == "T0000; T0001; T0002" and one.role == "STU"
    plan = _plan(df)
    assert "WindowGroupLimit" in plan and "partial_min" in plan
