"""Sinks: CSV exports and archive, cancellation digest, export positions."""
