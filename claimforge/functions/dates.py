"""Date parsing and day arithmetic."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimforge.schemas import DATE_FORMAT


def parse_date(name: str) -> Column:
    """Text to date; text that is no date becomes NULL instead of failing the job."""
    return F.try_to_date(F.col(name), DATE_FORMAT)


def day_span(start: Column | str, end: Column | str) -> Column:
    """Whole days from start to end; negative when end comes first."""
    return F.datediff(end, start)


def days_since(start: Column | str, as_of: dt.date | str | None = None) -> Column:
    """Whole days from start to ``as_of``, or to today when none is given."""
    until = F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")
    return F.datediff(until, start)
