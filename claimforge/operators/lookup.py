"""Left outer lookups that hold when a few keys own most of the rows.

``hot_keys`` finds heavy keys with a fixed-size sketch: the key columns are scanned
once and only sketches are shuffled. ``lookup`` resolves the rows of those keys
map-side, from a broadcast of at most ``MAX_HOT_KEYS`` dimension rows, and spreads
them, whether the dimension has them or not, like rows with a NULL key, over all
partitions of the regular join. The
dimension itself carries no hint: Catalyst and AQE broadcast it only when its size
is below the session threshold and shuffle it otherwise. Which keys are reported as
hot changes only the route a row takes, never the result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimforge.session import releasing

HOT_SHARE = 0.002
# No more keys than this can hold that share; as many again for a sketch's overestimates.
MAX_HOT_KEYS = 2 * int(1 / HOT_SHARE)
SKETCH_ITEMS = 4096
SKETCH_MERGERS = 256


@releasing
def hot_keys(df: DataFrame, *keys: str, share: float = HOT_SHARE) -> dict[str, list]:
    """Per key column, the values (NULL among them) that hold at least ``share`` of the rows.

    The sketches of all map tasks are merged by up to ``SKETCH_MERGERS`` tasks, and
    the driver receives their ``MAX_HOT_KEYS`` heaviest values each.
    """
    part = F.pmod(F.spark_partition_id(), F.lit(SKETCH_MERGERS))
    tops = [
        F.expr(f"approx_top_k(`{key}`, {MAX_HOT_KEYS}, {SKETCH_ITEMS})").alias(key) for key in keys
    ]
    merged = (
        df.select(*keys, part.alias("_part"))
        .groupBy("_part")
        .agg(*tops, F.count(F.lit(1)).alias("_rows"))
        .collect()
    )
    least = share * sum(row["_rows"] for row in merged)
    hot = {}
    for key in keys:
        counts = Counter()
        for row in merged:
            for entry in row[key]:
                counts[entry["item"]] += entry["count"]
        hot[key] = [value for value, n in counts.most_common() if n >= least]
    return hot


def lookup(
    facts: DataFrame,
    dim: DataFrame,
    key: str,
    hot: Sequence = (),
    spread_by: Sequence[str] = (),
) -> DataFrame:
    """``facts`` left joined to ``dim`` (unique on ``key``), one key column out.

    A hot key that ``dim`` holds twice fails the job. ``hot`` lists heavy key values as ``hot_keys`` reports them. ``spread_by`` names
    fact columns that tell rows apart, by default all of them; their hash places the
    rows of hot and NULL keys. A hash rather than a random number, so that a task run
    again after a lost executor sends every row to the same place. Exact copies of
    one row stay together there, and AQE splits their partition by size.
    """
    if not hot:
        return facts.join(dim, key, "left")

    columns = [key, *[name for name in facts.columns if name != key]]
    values = [name for name in dim.columns if name != key]
    heavy = [value for value in hot if value is not None]
    if len(heavy) > MAX_HOT_KEYS:
        raise ValueError(f"{len(heavy)} hot keys; a broadcast takes {MAX_HOT_KEYS}")
    is_hot = F.coalesce(F.col(key).isin(heavy), F.lit(False)) if heavy else F.lit(False)
    # Repeated dimension keys would make this side as large as the repetition.
    repeated = F.concat(F.lit(f"repeated {key} in a dimension: "), F.col(key).cast("string"))
    few = (
        dim.where(is_hot)
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("_copies"), F.first(F.struct(F.lit(1).alias("_one"), *values)).alias("_row"))
        .select(
            F.when(F.col("_copies") > 1, F.raise_error(repeated)).otherwise(F.col(key)).alias("_hot_key"),
            *[F.col(f"_row.{name}").alias(f"_hot_{name}") for name in values],
        )
    )
    facts = facts.join(F.broadcast(few), F.col(key) == F.col("_hot_key"), "left")
    # Hot keys leave the regular join by the list, not by the match: a heavy key that the
    # dimension lacks is spread as well.
    facts = facts.withColumn("_route", F.when(~is_hot, F.col(key)))
    spot = F.hash(*(spread_by or columns))
    facts = facts.withColumn("_spot", F.when(F.col("_route").isNull(), spot).otherwise(0))
    # pmod(hash, 1) is always 0, but not a constant the optimizer could fold away
    # and so take the spreading column out of the join key.
    side = dim.select(
        F.col(key).alias("_dim_key"),
        F.pmod(F.hash(key), F.lit(1)).alias("_dim_spot"),
        *[F.col(name).alias(f"_dim_{name}") for name in values],
    )
    same = (F.col("_route") == F.col("_dim_key")) & (F.col("_spot") == F.col("_dim_spot"))
    return facts.join(side, same, "left").select(*columns, *[_either(name) for name in values])


def _either(name: str) -> Column:
    cold, hot = F.col(f"_dim_{name}"), F.col(f"_hot_{name}")
    return F.when(F.col("_hot_key").isNull(), cold).otherwise(hot).alias(name)
