"""Key merge (type 1) and the incremental high-water mark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def merge_by_key(
    target: DataFrame,
    source: DataFrame,
    key: str = "claim_id",
    only_if_newer: str | None = None,
    gone: DataFrame | None = None,
) -> DataFrame:
    """Source rows replace target rows with the same key; other rows are kept.

    ``source`` must be unique on ``key``. ``only_if_newer`` names a time column and
    leaves a target row alone when the source row for it is older. ``gone`` has the keys
    to be replaced, for a part of a merge whose source rows may go to another part.
    """
    if only_if_newer:
        source = newer_rows(target, source, key, only_if_newer)
    kept = target.join(source.select(key) if gone is None else gone.select(key), key, "left_anti")
    return kept.unionByName(source.select(*target.columns))


def newer_rows(target: DataFrame, source: DataFrame, key: str, column: str) -> DataFrame:
    """Source rows whose key is new to the target or whose ``column`` is no less than there."""
    held = target.select(key, F.col(column).alias("_held"))
    joined = source.join(held, key, "left")
    return joined.where(F.col("_held").isNull() | (F.col(column) >= F.col("_held"))).select(*source.columns)


def merge_actions(target: DataFrame, source: DataFrame, key: str = "claim_id") -> DataFrame:
    """What a merge does with each key: updated, inserted or kept. Reads only the key."""
    held = target.select(key, F.lit(True).alias("_held"))
    sent = source.select(key, F.lit(True).alias("_sent"))
    action = (
        F.when(F.col("_held") & F.col("_sent"), "updated")
        .when(F.col("_sent"), "inserted")
        .otherwise("kept")
    )
    return held.join(sent, key, "full").select(key, action.alias("action"))


def past_mark(
    claims: DataFrame,
    target: DataFrame | None,
    column: str = "run_date",
    inclusive: bool = False,
    all_when_empty: bool = False,
) -> DataFrame:
    """Rows beyond the greatest ``column`` already in ``target``; all rows when there is no target.

    An empty target has no mark, so nothing passes unless ``all_when_empty`` is set.
    ``inclusive`` also lets the latest run pass again, which a key merge makes safe.
    """
    if target is None:
        return claims
    return past_value(claims, target.agg(F.max(column)).scalar(), column, inclusive, all_when_empty)


def past_value(
    claims: DataFrame, mark: Column, column: str = "run_date", inclusive: bool = False, all_when_empty: bool = False
) -> DataFrame:
    """Rows beyond a mark that is known already, for instance from a table's record."""
    value = F.col(column)
    passes = value >= mark if inclusive else value > mark
    return claims.where(passes | mark.isNull() if all_when_empty else passes)
