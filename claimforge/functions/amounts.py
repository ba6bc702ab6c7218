"""Money, ratios and rates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimforge.schemas import MONEY, RATIO


def money(name: str) -> Column:
    """An amount that does not fit becomes NULL; the extract step drops such rows and counts them."""
    return F.col(name).try_cast(MONEY)


def stored_ratio(name: str) -> Column:
    """A ratio too large for its storage type becomes NULL."""
    return F.col(name).try_cast(RATIO)


def ratio(part: str, whole: str) -> Column:
    """Four-digit ratio; NULL when the whole is zero or missing."""
    return F.round(F.try_divide(F.col(part).cast("double"), F.col(whole).cast("double")), 4)


def rate_pct(part: Column, whole: Column) -> Column:
    """Two-digit percentage; NULL when the whole is zero."""
    return F.round(part.cast("double") / F.nullif(whole, F.lit(0)) * 100, 2)
