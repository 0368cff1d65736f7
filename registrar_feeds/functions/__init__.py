"""Column helpers (built-in expressions only)."""

from registrar_feeds.functions import codes, dates

__all__ = ["codes", "dates"]
