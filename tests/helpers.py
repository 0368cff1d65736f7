"""Handmade registrar tables for unit tests."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from registrar_feeds.sources import SCHEMAS, stage

D = dt.date
TS = dt.datetime


def tables(spark, **rows) -> dict:
    """All registrar tables; the ones named get these rows (tuples in schema
    order), the rest are empty.  Staged like real input."""
    raw = {name: spark.createDataFrame(rows.get(name, []), SCHEMAS[name]) for name in SCHEMAS}
    return stage(raw)


def dec(x) -> Decimal:
    return Decimal(str(x))
