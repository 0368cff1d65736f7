"""What a scheduled run leaves on disk: its outputs, and nothing it worked with."""

import datetime as dt
import glob
import os
import time

import pytest
from pyspark.sql import functions as F

from registrar_feeds.asof import AsOf
from registrar_feeds.plans import runner
from registrar_feeds.plans.registry import registry
from registrar_feeds.session import CLEANUP, checkpoint_root, local_path, remove, scratch_dir, shuffles_freed
from registrar_feeds.sources import read_tables, write_tables
from tests.conftest import SMOKE_DIR

JULY = AsOf(dt.datetime(1998, 7, 15, 14, 0))


def _scratch(spark):
    return set(os.listdir(local_path(checkpoint_root(spark))))


def _shuffle_files(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for d in manager.localDirs() for f in glob.glob(f"{d.getPath()}/*/shuffle_*")}


def _freed(spark, before):
    """Files are removed beside the work: within some seconds."""
    for _ in range(40):
        if not _shuffle_files(spark) - before:
            return True
        time.sleep(0.25)
    return False


def test_a_scheduled_run_leaves_its_outputs_alone(spark):
    before, shuffled = _scratch(spark), _shuffle_files(spark)
    lines = registry()["scheduled_run"](spark, SMOKE_DIR)
    assert _freed(spark, shuffled)
    assert sorted(n.split("-")[0] for n in _scratch(spark) - before) == ["archive", "digest", "export"]
    assert {r.feed for r in lines.select("feed").distinct().collect()} == {"COURSES", "USERS", "ENROLLMENT", "CROSSLIST", "DIGEST"}


def test_the_tables_may_go_before_the_copies_are_written(spark, smoke_tables):
    base, out, arch = (scratch_dir(spark, n) for n in ("tables", "out", "arch"))
    write_tables(smoke_tables, base, "live")
    seen = []

    def gone():
        seen.append(os.path.exists(local_path(out)) or os.path.exists(local_path(arch)))
        remove(spark, base)

    written = runner.run_feeds(read_tables(spark, base, "live"), JULY, out, arch, tables_read=gone)
    assert seen == [False] and not os.path.exists(local_path(base))
    for name, paths in written.items():
        export, archive = (spark.read.text(paths[k]) for k in ("export", "archive"))
        assert export.count() > 100 and sorted(export.collect()) == sorted(archive.collect()), name


def test_a_run_that_fails_leaves_no_checkpoints(spark, stored_tables, monkeypatch):
    bad = {**runner.FEED_BUILDERS, "USERS": lambda t, a, school: t["id_rec"].select(
        *[F.raise_error(F.lit("no user")).cast("string").alias(c) for c in runner.CSV.EXPORT_COLUMNS["USERS"]])}
    monkeypatch.setattr(runner, "FEED_BUILDERS", bad)
    checkpoints = lambda: set(glob.glob(f"{local_path(checkpoint_root(spark))}/rdd-*/part-*"))
    before = checkpoints()
    with pytest.raises(Exception, match="no user"):
        runner.run_feeds(stored_tables, JULY, *(scratch_dir(spark, n) for n in ("out", "arch")))
    assert checkpoints() == before


def test_staged_files_hold_the_derived_columns(spark, smoke_tables):
    """They are derived again after the rows are dealt, not shuffled."""
    some = {n: smoke_tables[n] for n in ("sec_rec", "jenzcrs_rec", "jenztrm_rec", "crs_rec", "audit_sec_rec")}
    for audit_by in ("day", "month"):
        base = scratch_dir(spark, "derived")
        write_tables(some, base, "live", audit_by=audit_by)
        for name, back in read_tables(spark, base, "live", names=tuple(some)).items():
            back = back.select(*some[name].columns)
            assert back.count() > 0 and back.exceptAll(some[name]).count() == 0 == some[name].exceptAll(back).count(), name


def test_the_sessions_setting_comes_back(spark):
    before = spark.conf.get(CLEANUP)
    with pytest.raises(KeyError), shuffles_freed(spark):
        with shuffles_freed(spark):
            pass
        assert spark.conf.get(CLEANUP) == "true"
        raise KeyError
    assert spark.conf.get(CLEANUP) == before != "true"
