import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMOKE_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from registrar_feeds.session import build_session
    s = build_session("*", shuffle_partitions=8, app="registrar_feeds_tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def smoke_tables(spark):
    from registrar_feeds.sources import fixture_tables
    return fixture_tables(spark, SMOKE_DIR)


@pytest.fixture(scope="session")
def stored_tables(spark, smoke_tables):
    """The smoke tables written as staged Parquet and read back by the reader."""
    from registrar_feeds.session import scratch_dir
    from registrar_feeds.sources import read_tables, write_tables
    base = scratch_dir(spark, "test-tables")
    write_tables(smoke_tables, base, "train")
    return read_tables(spark, base, "train")
