"""The five feeds at the second fixture clock (seasonal gate and digest hour
closed) equal the oracle SQL at that clock."""

import pytest

from registrar_feeds import fixed_values as V
from registrar_feeds.asof import FIXTURE_AS_OF_CLOSED as S
from registrar_feeds.oracle import oracle_queries
from registrar_feeds.plans import feeds as FD
from registrar_feeds.sinks.digest import digest_lines
from tests.conftest import SMOKE_DIR
from tools.check_oracle import digest, duck

FEEDS = {
    "feed_courses": lambda t: FD.feed_courses(t, S, V.DEFAULT_SCHOOL),
    "feed_users": lambda t: FD.feed_users(t, S, V.DEFAULT_SCHOOL),
    "feed_enrollment": lambda t: FD.feed_enrollment(t, S),
    "feed_crosslist": lambda t: FD.feed_crosslist(t, S),
    "feed_cancelled_courses": lambda t: FD.feed_cancelled_courses(t, S),
}


@pytest.fixture(scope="module")
def con():
    return duck(SMOKE_DIR)


@pytest.mark.parametrize("key", sorted(FEEDS))
def test_feed_at_second_clock(smoke_tables, con, key):
    df = FEEDS[key](smoke_tables)
    res = con.execute(oracle_queries(as_of=S)[key])
    s_rows = [tuple(r) for r in df.collect()]
    o_rows = res.fetchall()
    assert len(s_rows) == len(o_rows) > 0
    assert digest(df.columns, s_rows)[0] == digest([d[0] for d in res.description], o_rows)[0]


def test_digest_closed_at_nine(smoke_tables):
    assert digest_lines(FD.feed_cancelled_courses(smoke_tables, S), S).count() == 0
