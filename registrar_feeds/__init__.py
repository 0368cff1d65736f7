"""Registrar feeds on Spark.

Turns a college registrar's tables into the feeds a learning management
system loads (courses and sections, users, enrolments, cross-listed sections,
newly cancelled courses), as lazy Spark DataFrames built from reusable
operators, plus the CSV / archive / digest sinks.

Layout:
    sources/    schemas, readers, staging, tables derived from the test data
    functions/  Column helpers (codes, slices, null defaults, number and date rules)
    operators/  DataFrame -> DataFrame operators (filters, joins, ranking, ...)
    plans/      the five feeds, the multi-feed run and the query registry
    sinks/      CSV export, timestamped archive, cancellation digest
    llm/        operators for training-data corpora (self-contained)

The feeds are full re-extracts of the registrar tables: there is no stream,
watermark or late data in them, so nothing here is a streaming query.
"""

from registrar_feeds.asof import AsOf

__all__ = ["AsOf"]
