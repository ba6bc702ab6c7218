"""Member history (type 2) and the point-in-time join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimforge.operators.lookup import hot_keys, lookup


def build_history(
    changes: DataFrame,
    key: str,
    day: str,
    attributes: Sequence[str],
    order: str,
) -> DataFrame:
    """Half-open versions ``[valid_from, valid_to)``; the open one has a NULL end.

    The greatest ``order`` of a key and day wins. That step is combined map-side and
    leaves at most one row per key and calendar day, which bounds the window below
    even for a key with very many changes.
    """
    daily = changes.groupBy(key, F.col(day).alias("valid_from")).agg(
        F.max(F.struct(order, *attributes)).alias("last")
    )
    by_day = Window.partitionBy(key).orderBy("valid_from")
    state = F.struct(*[F.col(f"last.{name}").alias(name) for name in attributes])
    previous = daily.select(
        key,
        "valid_from",
        state.alias("state"),
        F.lag(state).over(by_day).alias("previous"),
    )
    changed = previous.where(~F.col("state").eqNullSafe(F.col("previous"))).drop("previous")
    ended = changed.withColumn("valid_to", F.lead("valid_from").over(by_day))
    return ended.select(
        key,
        *[F.col(f"state.{name}").alias(name) for name in attributes],
        "valid_from",
        "valid_to",
        F.col("valid_to").isNull().alias("is_current"),
    )


def apply_changes(
    history: DataFrame,
    log: DataFrame,
    changes: DataFrame,
    key: str,
    day: str,
    attributes: Sequence[str],
    order: str,
) -> DataFrame:
    """History after a batch of changes; only keys in the batch are rebuilt.

    ``log`` holds all earlier changes: a version forgets re-sent values, and a late
    change that falls between two equal ones needs them. Append ``changes`` to the log
    afterwards. The result is what building from all changes gives, in any order.
    """
    touched = changes.select(key).distinct()
    untouched = history.join(touched, key, "left_anti")
    columns = [key, day, order, *attributes]
    known = log.join(touched, key, "left_semi").select(*columns)
    rebuilt = build_history(known.unionByName(changes.select(*columns)), key, day, attributes, order)
    return untouched.unionByName(rebuilt)


def hot_slots(facts: DataFrame, history: DataFrame, key: str, on_date: str) -> list:
    """Heavy key-and-year pairs for ``as_of_join``; scans these two columns of stored facts."""
    year = F.least(F.year(on_date), F.lit(_last_year(history)).cast("int"))
    return hot_keys(facts.select(_slot(key, year).alias("_slot")), "_slot")["_slot"]


def _last_year(history: DataFrame) -> int | None:
    return history.agg(F.max(F.year("valid_from")).alias("year")).first().year


def as_of_join(
    facts: DataFrame,
    history: DataFrame,
    key: str,
    on_date: str,
    spread_by: Sequence[str],
    hot: Sequence = (),
) -> DataFrame:
    """Each fact with the attributes of the version valid on its date; facts without one stay.

    The versions of a key are folded into one row per key and calendar year they
    touch, so the join is a plain equality, a fact meets only the versions of its
    own year (at most one per day), and one key's facts are spread over the years.
    A fact dated after the last year that starts a version uses that year. ``hot`` lists
    heavy pairs, as ``hot_slots`` finds them. ``history`` is read once for that year
    alone, once for the join, and once more for the hot pairs if there are any; facts
    are read once.
    """
    attributes = [
        name
        for name in history.columns
        if name not in (key, "valid_from", "valid_to", "is_current")
    ]
    last_year = F.lit(_last_year(history)).cast("int")
    # The least of a year and nothing is the year: an open version has no end.
    final = F.least(F.year(F.date_sub("valid_to", 1)), last_year)
    versions = (
        history.select(
            key,
            F.struct("valid_from", "valid_to", *attributes).alias("version"),
            F.explode(F.sequence(F.year("valid_from"), final)).alias("year"),
        )
        .groupBy(_slot(key, F.col("year")).alias("_slot"))
        .agg(F.collect_list("version").alias("_versions"))
    )
    year = F.least(F.year(on_date), last_year)
    placed = facts.withColumn("_slot", _slot(key, year))
    found = lookup(placed, versions, "_slot", hot, spread_by)
    day = F.col(on_date)
    valid = F.filter(
        "_versions",
        lambda v: (v["valid_from"] <= day) & (v["valid_to"].isNull() | (day < v["valid_to"])),
    )
    picked = found.withColumn("_version", F.get(valid, F.lit(0)))
    shown = [*attributes, "valid_from", "valid_to"]
    return picked.select(
        *facts.columns, *[F.col(f"_version.{name}").alias(name) for name in shown]
    )


def _slot(key: str, year: Column) -> Column:
    return F.concat(F.col(key).cast("string"), F.lit("@"), year.cast("string"))
