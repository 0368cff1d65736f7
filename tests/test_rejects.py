"""Enrolments with a bad person id: a failing query, or rejects and a whole feed."""

import datetime as dt

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from registrar_feeds.asof import AsOf
from registrar_feeds.plans import feeds as FD
from registrar_feeds.plans.runner import run_feeds
from registrar_feeds.session import scratch_dir
from tests.test_skew import _hot_term

SEPT = AsOf(dt.datetime(2024, 9, 10, 14, 0))


@pytest.fixture(scope="module")
def one_bad(spark):
    t = _hot_term(spark, 20)
    spoilt = F.when(F.col("host_id") == "3", F.lit(" 3x")).otherwise(F.col("host_id"))
    return {**t, "jenzcrp_rec": t["jenzcrp_rec"].withColumn("host_id", spoilt)}


def test_one_bad_id_is_one_reject_a_count_and_an_otherwise_whole_feed(spark, one_bad):
    with pytest.raises(Exception, match="not a numeric id: 3x"):
        FD.feed_enrollment(one_bad, SEPT).collect()
    seen = Observation("rejects")
    rows = FD.feed_enrollment(one_bad, SEPT, seen).collect()
    assert sorted(r.uniqueuserid for r in rows if r.coursecode == "C1 (UG)") == [i for i in range(20) if i != 3]
    assert seen.get == {"n_rejects": 1, "n_rows": 21}
    assert [tuple(r) for r in FD.enrollment_rejects(one_bad, SEPT).collect()] == [("C1 (UG)", "01", "RA 2024 UNDG", " 3x", "STU")]


def test_a_null_id_is_no_reject(spark, one_bad):
    t = {**one_bad, "jenzcrp_rec": one_bad["jenzcrp_rec"].withColumn("host_id", F.lit(None).cast("string"))}
    seen = Observation("rejects")
    assert all(r.uniqueuserid is None for r in FD.feed_enrollment(t, SEPT, seen).collect())
    assert seen.get["n_rejects"] == 0 and FD.enrollment_rejects(t, SEPT).count() == 0


def test_a_run_with_a_reject_folder(spark, one_bad):
    out, arch, bad = (scratch_dir(spark, n) for n in ("out", "arch", "bad"))
    written = run_feeds(one_bad, SEPT, out, arch, reject_dir=bad)["ENROLLMENT"]
    assert written["n_rejects"] == 1 and written["rejects"].endswith("/ENROLLMENT_REJECTS_20240910140000.csv")
    assert [r["host_id"] for r in spark.read.option("header", "true").csv(written["rejects"]).collect()] == [" 3x"]
    assert spark.read.option("header", "true").csv(written["export"]).count() == 20
