"""Column expressions for number and text formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Report line layout: name left-aligned in 32, count right-aligned in 10, formatted mean in 8.
REPORT_LINE_FORMAT = "%-32s %10d %8s"
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"
# Offset as +HH:MM, also for UTC (the form of Python's isoformat).
ISO_MILLIS_OFFSET = "yyyy-MM-dd'T'HH:mm:ss.SSSxxx"


def two_decimals(col: Column | str) -> Column:
    """Thousands separators and two decimals, as a string; NULL stays NULL."""
    return F.format_number(F.col(col) if isinstance(col, str) else col, 2)


def thousands(col: Column | str) -> Column:
    """Whole number with thousands separators (``{:,}``)."""
    return F.format_number(F.col(col) if isinstance(col, str) else col, 0)


def report_line(name: Column, count: Column, mean_text: Column, missing: str = "") -> Column:
    """One padded summary line (C14). A missing name or mean prints as ``missing``."""
    return F.format_string(REPORT_LINE_FORMAT, F.coalesce(name, F.lit(missing)), count,
                           F.coalesce(mean_text, F.lit(missing)))


def shift_hours(ts: Column, hours: int) -> Column:
    """Fixed clock shift (C10): a UTC instant shown on a clock ``hours`` ahead."""
    return ts + F.make_dt_interval(F.lit(0), F.lit(hours))


def iso_text(ts: Column, pattern: str = ISO_SECONDS) -> Column:
    """ISO-8601 text of a timestamp (C11)."""
    return F.date_format(ts, pattern)
