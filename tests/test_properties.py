"""Properties of the feeds on the derived test data, and plan checks."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from registrar_feeds.asof import FIXTURE_AS_OF as A
from registrar_feeds.operators import crosslist as X
from registrar_feeds.plans import feeds as FD
from registrar_feeds.sources import TABLES
from registrar_feeds.sources.schemas import PARTITION_COLUMNS

FEEDS = {
    "courses": lambda t: FD.feed_courses(t, A),
    "users": lambda t: FD.feed_users(t, A),
    "enrollment": lambda t: FD.feed_enrollment(t, A),
    "crosslist": lambda t: FD.feed_crosslist(t, A),
    "cancelled": lambda t: FD.feed_cancelled_courses(t, A),
}


def test_crosslist_master_is_max_and_not_a_member(smoke_tables):
    from registrar_feeds.functions import codes as C
    from registrar_feeds.operators import filters as Fl
    t = smoke_tables
    base = (t["secmtg_rec"].join(t["crs_rec"].select("crs_no", "cat", "prog"), ["crs_no", "cat"])
            .join(Fl.meeting_window(t["mtg_rec"], A).select("mtg_no", F.col("yr").alias("m_yr"),
                                                            F.col("sess").alias("m_sess")), "mtg_no")
            .select("mtg_no", C.school_code("m_yr", "m_sess", "crs_no", "sec_no", "cat", "prog").alias("code")))
    masters = X.shared_meeting_master(t, A)
    expect = base.groupBy("mtg_no").agg(F.max("code").alias("m"), F.count("*").alias("n")).where("n > 1")
    assert masters.join(expect, "mtg_no").where("targ_code <> m").count() == 0
    assert masters.count() == expect.count()
    feed = FD.feed_crosslist(smoke_tables, A)
    assert feed.where("crls_code = targ_code").count() == 0


def test_users_at_most_one_row_per_host(smoke_tables):
    u = FD.feed_users(smoke_tables, A)
    assert u.where("uniqueid is not null").groupBy("uniqueid").count().where("count > 1").count() == 0


def test_courses_invariant_to_input_order(spark, smoke_tables):
    shuffled = {k: smoke_tables[k].orderBy(F.rand(7)).repartition(5) for k in TABLES}
    a, b = FD.feed_courses(smoke_tables, A), FD.feed_courses(shuffled, A)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(FEEDS))
def test_plans_stay_in_the_jvm_without_cartesian(smoke_tables, name):
    plan = _plan(FEEDS[name](smoke_tables))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "CartesianProduct",
                "BroadcastNestedLoopJoin"):
        assert bad not in plan, (name, bad)


def test_filters_pushed_to_scans(stored_tables):
    plan = _plan(FD.feed_courses(stored_tables, A))
    assert "LessThanOrEqual(start_date,1999-01-15)" in plan
    assert "GreaterThanOrEqual(end_date,1998-06-15)" in plan
    assert "GreaterThan(stat_date,1998-07-11)" in plan
    plan = _plan(FD.feed_cancelled_courses(stored_tables, A))
    assert "EqualTo(stat,X)" in plan and "Not(EqualTo(stat,X))" in plan
    assert "GreaterThan(audit_timestamp,1998-07-14T00:00)" in plan
    assert "audit_date" in plan and "PartitionFilters: [isnotnull(audit_date" in plan


def test_stored_tables_give_the_same_feeds(stored_tables, smoke_tables):
    for name in sorted(FEEDS):
        a, b = FEEDS[name](stored_tables), FEEDS[name](smoke_tables)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_users_top1_is_window_group_limit(smoke_tables):
    plan = _plan(FD.feed_users(smoke_tables, A))
    assert "WindowGroupLimit" in plan


def _walk(node):
    """All nodes of an executed plan, inside adaptive stages too."""
    kind = node.getClass().getSimpleName()
    yield kind, node
    if kind == "AdaptiveSparkPlanExec":
        yield from _walk(node.executedPlan())
    elif kind.endswith("QueryStageExec"):
        yield from _walk(node.plan())
    elif kind == "ReusedExchangeExec":
        yield from _walk(node.child())
    children = node.children()
    for i in range(children.size()):
        yield from _walk(children.apply(i))


def _scans(df, table):
    """(folders read, text) of the scans of ``table`` in the plan that ran."""
    df.collect()
    out = []
    for kind, node in _walk(df._jdf.queryExecution().executedPlan()):
        if kind == "FileSourceScanExec":
            path = node.relation().location().rootPaths().head().toString()
            if path.endswith(f"/{table}"):
                out.append((node.metrics().apply("numPartitions").value(), f"{path} {node.simpleString(10_000)}"))
    return out


@pytest.mark.parametrize("feed,tables", [("courses", ("secmtg_rec", "sec_rec", "mtg_rec")),
                                         ("enrollment", ("jenzcrs_rec", "jenzcrp_rec"))])
@pytest.mark.parametrize("broadcasts", ["32MB", "-1"])
def test_history_is_pruned_in_the_plan_that_ran(spark, stored_tables, feed, tables, broadcasts):
    """The scans of partitioned history open only the years or terms at hand,
    whatever the planner may broadcast on its own."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, broadcasts)
        df = FEEDS[feed](stored_tables)
        for table in tables:
            column = PARTITION_COLUMNS[table][0]
            there = stored_tables[table].select(column).distinct().count()
            scans = _scans(df, table)
            assert scans and all("dynamicpruningexpression(true)" not in text for _, text in scans), table
            assert all(0 < n < there for n, _ in scans), (table, there, [n for n, _ in scans])
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_audit_opens_only_recent_days(stored_tables):
    """With default row groups: folders of earlier days are never opened."""
    days = stored_tables["audit_sec_rec"].select("audit_date").distinct()
    recent = days.where(F.col("audit_date") >= F.lit(A.days_ago(1))).count()
    scans = _scans(FD.cancelled_courses(stored_tables, A), "sec_rec")
    audit = [(n, t) for n, t in scans if "/audit/" in t]
    assert audit and all(n == recent for n, _ in audit) and recent < days.count()


def test_building_a_feed_starts_no_job(spark, stored_tables):
    sc = spark.sparkContext
    for name in sorted(FEEDS):
        sc.setJobGroup(f"build-{name}", name)
        FEEDS[name](stored_tables)
        assert sc.statusTracker().getJobIdsForGroup(f"build-{name}") == []
    sc._jsc.clearJobGroup()


def test_users_rows_are_candidates_of_their_person(spark):
    """USERS against the full joined form, without its cuts: every host with a
    surviving status and a person row is there once, and its row is one of the
    host's joined rows of best status (several contacts, titles and names per
    person, and equal people)."""
    import itertools
    import random

    from registrar_feeds import fixed_values as V
    from registrar_feeds.asof import AsOf
    import datetime as dt
    from tests.helpers import D, tables

    rng = random.Random(6)
    hosts = range(1, 41)
    pick = lambda n, make: [make(h) for h in hosts for _ in range(rng.randint(0, n))]
    status = pick(3, lambda h: (h, rng.choice(["STU", "FAC", "STF", "ALM", "GLL", None])))
    people = [(h, f"L{h % 5}", f"F{rng.randint(0, 2)}", "", None) for h in hosts for _ in range(rng.choice([1, 1, 2])) if h % 9]
    contact = pick(2, lambda h: (h, f"u{h}", f"u{rng.randint(0, 2)}@x"))
    jobs = pick(6, lambda h: (h, rng.randint(1, 4), rng.choice([None, D(2020, 1, 1), D(2030, 1, 1)]),
                              rng.choice(["Dean", "Chair", "x", None]), rng.choice(["VEN", "FVT", None])))
    enrolled = pick(2, lambda h: (h, rng.choice(["GOOD", "WD"]), rng.choice("YN")))
    names = pick(2, lambda h: (h, rng.choice("NM"), f"Nick{rng.randint(0, 2)}"))
    as_of = AsOf(dt.datetime(2024, 9, 10, 14, 0))
    t = tables(spark, jenzcst_rec=status, id_rec=people, jenzprs_rec=contact, job_rec=jobs, prog_enr_rec=enrolled,
               addree_rec=names, role_rec=[(3, "PREFF", None)])
    rank = {c: r for c, r in reversed(V.STATUS_PRIORITY)}
    want: dict = {}
    for h in hosts:
        mine = [s for k, s in status if k == h and s is not None and s not in V.EXCLUDED_STATUSES]
        rows = [p for p in people if p[0] == h]
        if not mine or not rows:
            continue
        open_ = lambda r, h=h: [(x[3], x[4]) for x in jobs if x[0] == h and x[1] == r and x[3] is not None
                                and (x[2] is None or x[2] > as_of.today)] or [(None, None)]
        tle = "Y" if any(e[0] == h and e[1] in V.GOOD_STANDING and e[2] == "Y" for e in enrolled) else None
        alt = [n[2] for n in names if n[0] == h and n[1] == "N"] or [None]
        mail = [c[1:] for c in contact if c[0] == h] or [(None, None)]
        want[h] = set()
        for p, (user, e), j1, j2, j3, nick in itertools.product(rows, mail, open_(1), open_(2), open_(3), alt):
            titles = [x[0] for x in (j1, j2, j3)]
            shown = [("" if i == 0 else "; ") + x if x not in (None, "x") else "" for i, x in enumerate(titles)]
            fac = (None if j1[1] is None else j1[1] not in V.NON_FACULTY_PAY) or tle == "Y"
            uid = None if user is None else str(h)
            want[h].add((p[2], nick, p[3], p[1], user, e, uid, "FAC" if fac else "STU", "".join(shown)))
        assert rank  # the best status never reaches a column: any surviving one makes the row
    got = [(r.firstname, r.preferred_first_name, r.middlename, r.lastname, r.username, r.email, r.uniqueid, r.role, r.position)
           for r in FD.feed_users(t, as_of).collect()]
    assert len(got) == len(set(got))
    named = {int(g[6]): g for g in got if g[6] is not None}
    reached = {h for h in want if any(c[6] is not None for c in want[h])}
    assert set(named) == reached and sum(g[6] is not None for g in got) == len(reached)
    assert all(g in want[h] for h, g in named.items())
    unnamed = {h for h in want if h not in reached}
    left = {g for g in got if g[6] is None}
    assert all(any(g in want[h] for h in unnamed) for g in left) and all(want[h] & left for h in unnamed)
