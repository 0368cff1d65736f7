"""The run clock.

Every feed reads "today" and "now" of the run.  Passing them explicitly makes
a run repeatable; nothing in the library calls ``current_date()``.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class AsOf:
    """Naive local wall-clock time of the run (the registrar's own time zone)."""

    ts: dt.datetime

    @classmethod
    def parse(cls, text: str) -> "AsOf":
        return cls(dt.datetime.fromisoformat(text))

    @property
    def today(self) -> dt.date:
        return self.ts.date()

    def today_lit(self) -> Column:
        return F.lit(self.today)

    def days_ago(self, n: int) -> dt.date:
        return self.today - dt.timedelta(days=n)

    def ts_lit(self) -> Column:
        # Built from text so the value does not depend on the Python process
        # or session time zone: registrar datetimes are naive.
        return F.lit(self.ts.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")

    def midnight_lit(self, days_back: int = 0) -> Column:
        d = self.days_ago(days_back)
        return F.lit(d.strftime("%Y-%m-%d 00:00:00")).cast("timestamp_ntz")

    def sql_date(self, days_back: int = 0) -> str:
        return f"DATE '{self.days_ago(days_back).isoformat()}'"

    def sql_ts(self) -> str:
        return f"TIMESTAMP '{self.ts.strftime('%Y-%m-%d %H:%M:%S')}'"


# The clock of the test fixtures: seasonal gate and digest hour both open.
FIXTURE_AS_OF = AsOf(dt.datetime(1998, 7, 15, 14, 0, 0))
# Second clock: both closed.
FIXTURE_AS_OF_CLOSED = AsOf(dt.datetime(1998, 9, 15, 9, 0, 0))
