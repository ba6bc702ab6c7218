"""Row validation, typing and audit columns of the extract step."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimforge.functions import digest, keyed_digest, parse_date
from claimforge.schemas import AMOUNT_LIMIT

REQUIRED_KEYS = ("claim_id", "member_id")
# The documented variant of the required-field check.
REQUIRED_FIELDS = ("claim_id", "service_date", "billed_amount")
AMOUNTS = ("billed_amount", "paid_amount")
DATES = ("service_date", "discharge_date")


def present(*names: str) -> Column:
    cond = F.lit(True)
    for name in names:
        cond = cond & F.col(name).isNotNull()
    return cond


def non_negative(*names: str) -> Column:
    """Amounts from 0 to below the limit of the money type.

    NaN and Infinity are above every limit. NULL when an amount is NULL, so a filter
    on it drops the row.
    """
    cond = F.lit(True)
    for name in names:
        cond = cond & (F.col(name) >= 0) & (F.col(name) < AMOUNT_LIMIT)
    return cond


def require(df: DataFrame, *names: str) -> DataFrame:
    return df.where(present(*(names or REQUIRED_KEYS)))


def drop_negative(df: DataFrame, *names: str) -> DataFrame:
    return df.where(non_negative(*(names or AMOUNTS)))


def type_dates(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: parse_date(name) for name in names or DATES})


def stamp(
    df: DataFrame, run_date: str, env: str, as_of: dt.datetime | str | None = None
) -> DataFrame:
    """Audit columns; ``as_of`` pins the clock."""
    now = F.current_timestamp() if as_of is None else F.lit(str(as_of)).cast("timestamp")
    return df.withColumns({"run_date": F.lit(run_date), "ingested_at": now, "env": F.lit(env)})


def mask_members(df: DataFrame, key: str | None = None) -> DataFrame:
    """Replace member_id by its digest; a dimension needs the same call before a join."""
    masked = digest("member_id") if key is None else keyed_digest("member_id", key)
    return df.withColumn("member_id", masked)


def tokenize_providers(df: DataFrame, key: str) -> DataFrame:
    return df.withColumn("provider_npi", keyed_digest("provider_npi", key))


def clean(
    raw: DataFrame,
    run_date: str,
    env: str,
    as_of: dt.datetime | str | None = None,
    required: tuple[str, ...] = REQUIRED_KEYS,
) -> DataFrame:
    kept = drop_negative(require(raw, *required))
    return stamp(type_dates(kept), run_date, env, as_of)
