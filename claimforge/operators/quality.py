"""Data checks. Everything about one table except uniqueness is one aggregate."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimforge.operators.cleaning import AMOUNTS, REQUIRED_KEYS, non_negative, present
from claimforge.schemas import (
    CLAIM_STATUSES,
    CLAIM_TYPES,
    FRESHNESS_ERROR_HOURS,
    FRESHNESS_WARN_HOURS,
)


@dataclass(frozen=True)
class Check:
    """One rule; ``failing`` is true for a bad row, and NULL counts as good."""

    rule: str
    column: str
    failing: Column


def not_null(name: str) -> Check:
    return Check("not_null", name, F.col(name).isNull())


def accepted_range(name: str, low: float | None = None, high: float | None = None) -> Check:
    failing = F.lit(False)
    if low is not None:
        failing = failing | (F.col(name) < low)
    if high is not None:
        failing = failing | (F.col(name) > high)
    return Check("accepted_range", name, failing)


def accepted_values(name: str, values: Sequence[str]) -> Check:
    return Check("accepted_values", name, ~F.col(name).isin(list(values)))


def claim_checks(claim_types: Sequence[str] = CLAIM_TYPES) -> list[Check]:
    return [
        not_null("claim_id"),
        not_null("member_id"),
        not_null("billed_amount"),
        accepted_range("billed_amount", low=0),
        accepted_range("paid_amount", low=0),
        accepted_values("claim_status", CLAIM_STATUSES),
        accepted_values("claim_type", claim_types),
    ]


def mart_checks() -> list[Check]:
    return [
        accepted_range("total_claims", low=0),
        accepted_range("denial_rate_pct", low=0, high=100),
    ]


def count_failures(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row per check: ``rule``, ``column_name``, ``failures``."""
    counts = df.agg(
        *[F.count_if(check.failing).alias(f"n{i}") for i, check in enumerate(checks)]
    )
    rows = [
        F.struct(
            F.lit(check.rule).alias("rule"),
            F.lit(check.column).alias("column_name"),
            F.col(f"n{i}").alias("failures"),
        )
        for i, check in enumerate(checks)
    ]
    return counts.select(F.inline(F.array(*rows)))


def duplicates(df: DataFrame, key: str = "claim_id") -> DataFrame:
    """Keys that occur more than once, with their number of copies; NULL is no key."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("copies"))
        .where(F.col("copies") > 1)
    )


def require_unique(df: DataFrame, key: str, name: str) -> None:
    """Fail before a join or merge that a repeated key would make ambiguous."""
    sample = duplicates(df.select(key), key).take(1)
    if sample:
        raise ValueError(f"{name} is not unique on {key}: {sample[0][key]!r}")


def integrity_report(claims: DataFrame, mart: DataFrame, repeated: DataFrame | None = None) -> DataFrame:
    """All table checks: one row per rule and column.

    ``repeated`` has a row per claim id that is not unique, where that is known without
    grouping all of ``claims``.
    """
    repeated = duplicates(claims) if repeated is None else repeated
    repeated = repeated.agg(
        F.lit("unique").alias("rule"),
        F.lit("claim_id").alias("column_name"),
        F.count(F.lit(1)).alias("failures"),
    )
    return (
        repeated.unionByName(count_failures(claims, claim_checks()))
        .withColumn("table_name", F.lit("stg_claims"))
        .unionByName(
            count_failures(mart, mart_checks()).withColumn(
                "table_name", F.lit("mart_claims_summary")
            )
        )
        .select("table_name", "rule", "column_name", "failures")
    )


def freshness(
    df: DataFrame,
    as_of: dt.datetime | str | None = None,
    loaded_at: str = "ingested_at",
    warn_hours: int = FRESHNESS_WARN_HOURS,
    error_hours: int = FRESHNESS_ERROR_HOURS,
) -> DataFrame:
    """Age of the newest row in hours and its status; an empty table is an error."""
    now = F.current_timestamp() if as_of is None else F.lit(str(as_of)).cast("timestamp")
    newest = df.agg(F.max(F.col(loaded_at).cast("timestamp")).alias("newest"))
    age = (F.unix_timestamp(now) - F.unix_timestamp("newest")) / 3600
    status = (
        F.when(F.col("age_hours").isNull() | (F.col("age_hours") > error_hours), "error")
        .when(F.col("age_hours") > warn_hours, "warn")
        .otherwise("pass")
    )
    return newest.withColumn("age_hours", age).withColumn("status", status)


def daily_counts(df: DataFrame, day: Column | str) -> DataFrame:
    column = F.col(day) if isinstance(day, str) else day
    return df.groupBy(column.cast("date").alias("day")).agg(F.count(F.lit(1)).alias("rows"))


def row_count_trend(
    counts: DataFrame, days: int = 7, min_share: float | None = None
) -> DataFrame:
    """Each day's count beside the average of the counted days among the ``days`` before it.

    A day's count is sent to itself and to the days that look back on it and summed up
    there, so ``counts`` is read once and no ordered pass over all days is needed.
    ``min_share`` sets ``suspicious`` when the count is below that share of the average.
    """
    later = F.explode(F.sequence(F.lit(0), F.lit(days))).alias("later")
    sent = counts.select("day", F.col("rows").alias("n"), later).where("later = 0 or day is not null")
    own, before = F.when(F.col("later") == 0, F.col("n")), F.when(F.col("later") > 0, F.col("n"))
    average = F.try_divide(F.sum(before).cast("double"), F.count(before))
    found = (
        sent.groupBy(F.date_add("day", F.col("later")).alias("day"))
        .agg(F.max(own).alias("rows"), F.round(average, 4).alias("avg_before"))
        .where(F.col("rows").isNotNull())
    )
    low = F.lit(None).cast("boolean")
    if min_share is not None:
        low = F.col("rows") < F.lit(min_share) * F.col("avg_before")
    return found.withColumn("suspicious", low)


def validation_counts(raw: DataFrame) -> DataFrame:
    """Rows read, valid and dropped, in one pass."""
    valid = present(*REQUIRED_KEYS) & non_negative(*AMOUNTS)
    counted = raw.agg(
        F.count(F.lit(1)).alias("rows_in"), F.count_if(valid).alias("rows_valid")
    )
    return counted.withColumn("rows_dropped", F.col("rows_in") - F.col("rows_valid"))
