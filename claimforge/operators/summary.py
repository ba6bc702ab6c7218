"""Monthly summary measures."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimforge.functions import rate_pct
from claimforge.functions.privacy import packed
from claimforge.operators.median import exact_median
from claimforge.schemas import MART_KEYS

# The measures in column order.
MEASURES = [
    "total_claims",
    "unique_members",
    "unique_providers",
    "total_billed",
    "total_allowed",
    "total_paid",
    "avg_paid_per_claim",
    "median_paid_per_claim",
    "denied_claims",
    "high_cost_claims",
    "out_of_network_claims",
    "denial_rate_pct",
    "avg_los_days",
    "avg_cost_ratio",
    "avg_member_risk_score",
]
MEDIAN = "median_paid_per_claim"
# Measures that count the distinct values of a column.
DISTINCT = {"total_claims": "claim_id", "unique_members": "member_id", "unique_providers": "provider_npi"}
PAYER_KEYS = ["plan_id", "claim_type", "service_year", "service_month"]


def _average(name: str, kind: T.DataType) -> Column:
    """Four digits, half up. Decimal and whole numbers are divided as decimals, so an
    exact tie is seen as one and the row order does not matter. A group may have up to
    10^14 rows; beyond that, or where a sum outgrows its type, the job fails."""
    total, n = F.sum(name), F.nullif(F.count(name), F.lit(0))
    if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
        return F.round(total / n, 4)
    if not isinstance(kind, T.DecimalType):
        total = total.cast("decimal(20,0)")
    return F.round(total / n.cast("decimal(14,0)"), 4).cast("double")


def _flagged(name: str) -> Column:
    return F.count_if(F.coalesce(F.col(name), F.lit(False)))


def _measure(name: str, types: T.StructType, claims_unique: bool, distinct: str) -> Column:
    def average(column: str) -> Column:
        return _average(column, types[column].dataType)

    count = {"exact": F.count_distinct, "approx": F.approx_count_distinct}[distinct]
    claims = F.count("claim_id") if claims_unique else count("claim_id")
    return {
        "total_claims": lambda: claims,
        # Shuffled once per group and member, so as few bytes as tell members apart.
        "unique_members": lambda: count(packed("member_id") if types["member_id"].dataType == T.StringType() else "member_id"),
        "unique_providers": lambda: count("provider_npi"),
        "total_billed": lambda: F.sum("billed_amount"),
        "total_allowed": lambda: F.sum("allowed_amount"),
        "total_paid": lambda: F.sum("paid_amount"),
        "avg_paid_per_claim": lambda: average("paid_amount"),
        "denied_claims": lambda: _flagged("denied_flag"),
        "high_cost_claims": lambda: _flagged("high_cost_flag"),
        "out_of_network_claims": lambda: _flagged("out_of_network_flag"),
        "denial_rate_pct": lambda: rate_pct(_flagged("denied_flag"), claims),
        "avg_los_days": lambda: average("length_of_stay_days"),
        "avg_cost_ratio": lambda: average("cost_ratio"),
        "avg_member_risk_score": lambda: average("risk_score"),
    }[name]().alias(name)


def summarize(
    base: DataFrame,
    keys: Sequence[str] = MART_KEYS,
    measures: Sequence[str] = MEASURES,
    claims_unique: bool = False,
    median: str = "exact",
    distinct: str = "exact",
    stored: bool = False,
    member_first: str | None = None,
    narrow: DataFrame | None = None,
) -> DataFrame:
    """Measures per group; NULL is a group of its own.

    ``claims_unique`` states that ``claim_id`` is unique in ``base``, as it is after
    a key merge or ``latest_per_key``. The distinct claim count is then a plain
    count, which spares a shuffle of every claim id. ``median="approx"`` swaps the
    exact median for a bounded sketch, ``distinct="approx"`` the distinct counts. The exact median and the other measures each
    scan ``base``, so give it from stored data.

    ``stored`` states that ``base`` is: each exact distinct count then scans its one column and
    moves nothing else, where Spark expands every row once per count. ``member_first`` names a
    column that is true in one row of each group and member (``mark_first``), which spares the
    count of members its shuffle. ``narrow`` has the same rows as ``base`` before the member's
    attributes were joined: what needs none of them, the median and those counts, is taken from it.
    """
    grouped = base.withColumn("_group", F.struct(*keys))
    aside = grouped if narrow is None else narrow.withColumn("_group", F.struct(*keys))
    split = (stored or narrow is not None) and distinct == "exact"
    apart = [name for name in measures if name in DISTINCT] if split else []
    if claims_unique and "total_claims" in apart:
        apart.remove("total_claims")
    marked = [name for name in measures if name == "unique_members" and member_first]
    apart = [name for name in apart if name not in marked]
    plain = [
        _measure(name, base.schema, claims_unique, distinct)
        for name in measures
        if name != MEDIAN and name not in [*apart, *marked]
    ]
    plain += [F.count_if(F.col(member_first) & F.col("member_id").isNotNull()).alias(name) for name in marked]
    if MEDIAN in measures and median == "approx":
        plain.append(F.percentile_approx("paid_amount", 0.5).cast("double").alias(MEDIAN))
    totals = grouped.groupBy("_group").agg(*plain) if plain else None
    if MEDIAN in measures and median == "exact":
        middles = exact_median(aside, "_group", "paid_amount").select(
            "_group", F.round("median", 4).alias(MEDIAN)
        )
        if totals is None:
            totals = aside.select("_group").distinct()
        totals = totals.join(middles, "_group", "left")
    for name in apart:
        one = aside.select("_group", DISTINCT[name]).distinct().groupBy("_group")
        one = one.agg(F.count(DISTINCT[name]).alias(name))
        totals = one if totals is None else totals.join(one, "_group")
    return totals.select("_group.*", *measures)


def mark_first(rows: DataFrame, name: str, keys: Sequence[str] = MART_KEYS) -> DataFrame:
    """``name`` is true in one row of each member and group.

    Rows that a join has just placed by member are ordered where they are, without a shuffle.
    """
    order = Window.partitionBy("member_id", *keys).orderBy("claim_id")
    return rows.withColumn(name, F.row_number().over(order) == 1)


def monthly_summary(
    base: DataFrame, as_of: dt.datetime | str | None = None, **options
) -> DataFrame:
    """The mart: six keys, fifteen measures and the build time."""
    now = F.current_timestamp() if as_of is None else F.lit(str(as_of)).cast("timestamp")
    return summarize(base, **options).withColumn("updated_at", now)


def payer_summary(base: DataFrame, **options) -> DataFrame:
    """The documented coarser variant: payer, claim type and month."""
    return summarize(base, PAYER_KEYS, **options)
