"""Latest record per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(
    df: DataFrame,
    key: str = "claim_id",
    newest: str = "ingested_at",
    ties: Sequence[str] | None = None,
) -> DataFrame:
    """One row per key: the greatest ``newest``, then the greatest ``ties``.

    Rows of one run share their ingestion time, so the time alone would pick an
    arbitrary copy. By default every other column breaks ties, in column order.

    Spark keeps only the first row per key within each map task before the shuffle
    (``WindowGroupLimit``), so a key with very many copies sends one row per task.
    """
    if ties is None:
        ties = [name for name in df.columns if name not in (key, newest)]
    order = [F.col(name).desc_nulls_last() for name in (newest, *ties)]
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")
