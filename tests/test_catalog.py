"""Registrar tables by their names in the catalog, and bucketed meetings."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from registrar_feeds.asof import FIXTURE_AS_OF as A
from registrar_feeds.operators import sections as S
from registrar_feeds.plans import feeds as FD
from registrar_feeds.session import scratch_dir
from registrar_feeds.sources.schemas import BUCKET_COLUMNS
from registrar_feeds.sources import catalog_tables, read_tables, register_tables, store_tables, table_name, table_path
from registrar_feeds.sources.catalog import _buckets, even
from tests.test_properties import _walk


@pytest.fixture(scope="module")
def stored(spark, smoke_tables):
    base = scratch_dir(spark, "catalog")
    store_tables(smoke_tables, base, "live", buckets=4, audit_by="month")
    return base


def _kinds(df):
    df.collect()
    return [kind for kind, _ in _walk(df._jdf.queryExecution().executedPlan())]


def _same(a, b):
    assert sorted(a.columns) == sorted(b.columns)
    rows = lambda df: sorted(map(str, df.select(*sorted(a.columns)).collect()))
    return rows(a) == rows(b)


def test_names_and_namespaces(spark, stored):
    assert table_name("LIVE", "sec_rec") == "registrar_live.sec_rec"
    assert table_name("train", "audit_sec_rec") == "registrar_train_audit.sec_rec"
    assert spark.catalog.tableExists("registrar_live_audit.sec_rec")
    assert spark.sql("SELECT count(*) FROM registrar_live_audit.sec_rec WHERE stat = 'X'").first()[0] > 0


def test_catalog_tables_give_the_same_feeds(spark, stored, smoke_tables):
    t = catalog_tables(spark)
    for build in (FD.feed_courses, FD.feed_cancelled_courses):
        assert _same(build(t, A), build(smoke_tables, A))
    # the files are there by path as well, buckets or not
    assert _same(read_tables(spark, stored)["mtg_rec"], smoke_tables["mtg_rec"])


@pytest.mark.parametrize("broadcasts", ["32MB", "-1"])
def test_meeting_pattern_joins_buckets_without_an_exchange(spark, stored, smoke_tables, broadcasts):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k) for k in keys}
    buildings = smoke_tables["bldg_table"]
    try:
        for k in keys:
            spark.conf.set(k, broadcasts)
        t = {**catalog_tables(spark), "bldg_table": F.broadcast(buildings)}
        df = S.meet_pattern(t)
        assert "ShuffleExchangeExec" not in _kinds(df)
        assert "ShuffleExchangeExec" in _kinds(S.meet_pattern({**smoke_tables, "bldg_table": F.broadcast(buildings)}))
        assert _same(df, S.meet_pattern(smoke_tables))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_a_new_session_names_the_tables_as_they_were_written(spark, stored, smoke_tables):
    assert _buckets(spark, table_path(stored, "live", "mtg_rec")) == 4
    for name in BUCKET_COLUMNS:
        spark.sql(f"DROP TABLE {table_name('live', name)}")
    register_tables(spark, stored, "live", tuple(BUCKET_COLUMNS))
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        spark.sql("DESCRIBE EXTENDED registrar_live.mtg_rec").where("col_name = 'Num Buckets'").show(1, False)
    assert "|4 " in out.getvalue()
    t = {**catalog_tables(spark), "bldg_table": F.broadcast(smoke_tables["bldg_table"])}
    assert "ShuffleExchangeExec" not in _kinds(S.meet_pattern(t))
    assert _same(S.meet_pattern(t), S.meet_pattern(smoke_tables))


def test_a_hot_meeting_is_not_bucketed(spark, smoke_tables):
    hot = smoke_tables["secmtg_rec"].withColumn("mtg_no", F.when(F.col("mtg_no") % 2 == 0, F.lit(1).cast("long")).otherwise(F.col("mtg_no")))
    two = {"secmtg_rec": hot, "mtg_rec": smoke_tables["mtg_rec"]}
    assert not even(two, 16) and even({n: smoke_tables[n] for n in two}, 16)
    base = scratch_dir(spark, "catalog")
    store_tables(two, base, "train", buckets=16)
    assert _buckets(spark, table_path(base, "train", "secmtg_rec")) is None
    assert _same(catalog_tables(spark, "train", ("secmtg_rec",))["secmtg_rec"], hot)


def test_an_older_staging_is_not_registered(spark, smoke_tables):
    base = scratch_dir(spark, "catalog")
    smoke_tables["sec_rec"].drop("course_key").write.parquet(table_path(base, "train", "sec_rec"))
    with pytest.raises(ValueError, match="sec_rec: columns absent: course_key"):
        register_tables(spark, base, "train", ("sec_rec",))
