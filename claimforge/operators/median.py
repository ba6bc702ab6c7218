"""Exact median per group without holding a group in one task, from counts per cent.

The built-in median keeps every distinct value of a group in one aggregation buffer.
Here the amounts become whole cents and are counted per cent value: these counts can be
added, taken from and stored (``cent_counts``), and the median is located in them. A
group of at most ``MOST_VALUES`` distinct values is ordered in one window. The middle
ranks of a larger one are located in three steps: among blocks of 2**40 cents, within
the found block among blocks of 2**20 cents, and within that among cents. Rows are
combined map-side before the shuffle, and a large group is spread by value. A task orders
at most 2**21 entries of one group and step, whatever the amounts are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Low bits of a cent value that a step leaves open.
STEPS = (40, 20, 0)
MOST_VALUES = 1 << 21


def exact_median(df: DataFrame, group: str, amount: str, scale: int = 2) -> DataFrame:
    """``group``, ``median`` (double) for groups with at least one amount.

    ``group`` is one column, usually a struct of the grouping columns, so that NULL
    grouping values compare equal. ``amount`` must be whole numbers or decimals that
    fit decimal(18, scale); other types are refused, as rounding would change the
    result. All steps read the shuffled counts of the first aggregation; ``df`` is
    computed once.
    """
    return located_median(cent_counts(df, [group], amount, scale), group, scale)


def cent_counts(
    df: DataFrame, keys: Sequence[str], amount: str, scale: int = 2, weight: Column | None = None
) -> DataFrame:
    """``keys``, ``cent`` and ``n``: how often each group has each amount.

    ``weight`` counts a row otherwise than once: -1 takes it away. Counts of several
    frames add up; entries that add up to nothing are left out.
    """
    _require_exact(df.schema[amount].dataType, amount, scale)
    units = (F.col(amount).cast(f"decimal(18,{scale})") * 10**scale).cast("bigint")
    counts = df.where(F.col(amount).isNotNull()).groupBy(*keys, units.alias("cent"))
    if weight is None:
        return counts.agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.sum(weight).cast("bigint").alias("n")).where("n <> 0")


def located_median(cents: DataFrame, group: str, scale: int = 2) -> DataFrame:
    """``group``, ``median`` of counts per cent, with at most one row per group and cent."""
    if not isinstance(cents.schema[group].dataType, T.StructType):
        # The joins below would lose the group NULL, but not a struct that holds it.
        found = located_median(cents.withColumn(group, F.struct(F.col(group).alias("key"))), group, scale)
        return found.withColumn(group, F.col(group)["key"])
    totals = cents.groupBy(group).agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("values"))
    # Inner joins, which stay above the counts: a semi or anti join would be pushed below
    # them, and every step would then shuffle counts of its own.
    is_large = F.col("values") > MOST_VALUES
    small = cents.join(totals.where(~is_large), group)
    found = _in_one_window(small, group).unionByName(_in_steps(cents, totals.where(is_large), group))
    both = F.sum(F.col("place") * F.col("hits")).cast("double")
    return found.groupBy(group).agg((both / (2 * 10**scale)).alias("median"))


def _hits(first: Column, upto: Column, total: Column) -> Column:
    """How many of the two middle ranks, counted from 1, lie in (first, upto]; they are equal if the total is odd."""
    low, high = F.shiftright(total + 1, 1), F.shiftright(total + 2, 1)
    return sum([((rank > first) & (rank <= upto)).cast("int") for rank in (low, high)], F.lit(0))


def _in_one_window(cents: DataFrame, group: str) -> DataFrame:
    ordered = Window.partitionBy(group).orderBy("cent")
    upto = F.sum("n").over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = cents.select(group, F.col("cent").alias("place"), "n", upto.alias("upto"), "total")
    hits = _hits(F.col("upto") - F.col("n"), F.col("upto"), F.col("total"))
    return placed.select(group, "place", hits.alias("hits")).where("hits > 0")


def _in_steps(cents: DataFrame, totals: DataFrame, group: str) -> DataFrame:
    found = totals.select(group, "total", F.lit(0).cast("bigint").alias("before"), F.lit(0).alias("place"))
    # At most one group in MOST_VALUES entries: few, whatever the number of groups is.
    cents = cents.join(totals, group).select(group, "cent", "n")
    last = None
    for step in STEPS:
        # Never NULL: a filter that says so would reach the scan and set this step's counts apart.
        place = F.lit(0) if last is None else F.coalesce(F.shiftright("cent", last), F.lit(0))
        counts = cents.groupBy(group, place.alias("place"), F.shiftright("cent", step).alias("block"))
        counts = counts.agg(F.sum("n").alias("n")).join(found, [group, "place"])
        ordered = Window.partitionBy(group, "place").orderBy("block")
        upto = F.sum("n").over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        counts = counts.withColumn("upto", F.col("before") + upto).withColumn("first", F.col("upto") - F.col("n"))
        counts = counts.withColumn("hits", _hits(F.col("first"), F.col("upto"), F.col("total"))).where("hits > 0")
        found = counts.select(group, "total", F.col("first").alias("before"), F.col("block").alias("place"), "hits")
        last = step
        if step != STEPS[-1]:
            found = found.drop("hits")
    return found.select(group, "place", "hits")


def _require_exact(kind: T.DataType, name: str, scale: int) -> None:
    whole = isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType))
    fits = isinstance(kind, T.DecimalType) and kind.scale <= scale and kind.precision - kind.scale <= 18 - scale
    if not (whole or fits):
        raise TypeError(f"{name} is {kind.simpleString()}, not a number that fits decimal(18,{scale})")
