"""Composite plans: Silver, dimensions, calendar, fact, reports, suites."""
from . import silver, dimensions, fact, reports, suites, star

__all__ = ["silver", "dimensions", "fact", "reports", "suites", "star"]
