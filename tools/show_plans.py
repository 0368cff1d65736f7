"""Print the formatted physical plan of each feed over staged tables.

Usage: python tools/show_plans.py [sf_dir] [feed ...]

Stages the test tables to Parquet under the checkpoint folder first, so the
plans show the scans as the feeds see them in production (pushed filters,
read schemas).  With --final the feed is run first and the final adaptive
plan is printed.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from registrar_feeds.asof import FIXTURE_AS_OF as A  # noqa: E402
from registrar_feeds.plans import feeds as FD  # noqa: E402
from registrar_feeds.session import build_session, scratch_dir  # noqa: E402
from registrar_feeds.sources import fixture_tables, read_tables, write_tables  # noqa: E402

FEEDS = {
    "courses": lambda t: FD.feed_courses(t, A),
    "users": lambda t: FD.feed_users(t, A),
    "enrollment": lambda t: FD.feed_enrollment(t, A),
    "crosslist": lambda t: FD.feed_crosslist(t, A),
    "cancelled_courses": lambda t: FD.feed_cancelled_courses(t, A),
}


def main(argv: list[str]) -> None:
    final = "--final" in argv
    args = [a for a in argv if a != "--final"]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:] or list(FEEDS)
    spark = build_session(8)
    base = scratch_dir(spark, "plan-tables")
    write_tables(fixture_tables(spark, sf_dir), base, "live")
    t = read_tables(spark, base, "live")
    for name in names:
        df = FEEDS[name](t)
        if final:
            df.collect()
        print(f"===== {name} =====")
        df.explain(mode="formatted")


if __name__ == "__main__":
    main(sys.argv[1:])
