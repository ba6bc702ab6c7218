"""Warehouse models: staging view, enriched claims, monthly mart."""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimforge.functions import fold_lower, fold_upper, money
from claimforge.functions.amounts import stored_ratio
from claimforge.functions.privacy import packed, packed_text, unpacked
from claimforge.operators.enrich import attach_dimensions, categorize
from claimforge.operators.latest import latest_per_key
from claimforge.operators.lookup import hot_keys
from claimforge.operators.merge import past_value
from claimforge.operators.quality import duplicates, require_unique
from claimforge.operators.summary import mark_first, monthly_summary
from claimforge.schemas import CATEGORIZED, DIM_MEMBERS, DIM_PROVIDERS, FACT_COLUMNS
from claimforge.session import releasing
from claimforge.sources import versions, writers


def usable() -> Column:
    """A fact row that is no obvious garbage; reads stored columns, so it reaches the scan."""
    return (
        F.col("claim_id").isNotNull()
        & F.col("member_id").isNotNull()
        & (F.col("billed_amount") >= 0)
        & F.col("service_date").isNotNull()
    )


def stg_claims(fact: DataFrame) -> DataFrame:
    """Typed, trimmed and case-folded fact rows without obvious garbage."""
    changed = {
        "service_date": F.col("service_date").cast("date"),
        "discharge_date": F.col("discharge_date").cast("date"),
        "diagnosis_code": fold_upper("diagnosis_code"),
        "procedure_code": fold_upper("procedure_code"),
        "billed_amount": money("billed_amount"),
        "allowed_amount": money("allowed_amount"),
        "paid_amount": money("paid_amount"),
        "claim_status": fold_upper("claim_status"),
        "claim_type": fold_lower("claim_type"),
        "cost_ratio": stored_ratio("cost_ratio"),
    }
    return fact.where(usable()).select(
        *[changed.get(name, F.col(name)).alias(name) for name in FACT_COLUMNS]
    )


def int_claims(
    stg: DataFrame,
    dim_members: DataFrame | None,
    dim_providers: DataFrame | None,
    as_of: dt.date | str | None = None,
    hot: dict[str, list] | None = None,
) -> DataFrame:
    joined = attach_dimensions(stg, dim_members, dim_providers, hot)
    return categorize(joined, as_of)


def int_claims_packed(
    stg: DataFrame,
    dim_members: DataFrame,
    dim_providers: DataFrame,
    as_of: dt.date | str | None,
    hot: dict[str, list],
    once: bool,
) -> DataFrame:
    """The latest run's row of each claim with its attributes; members are bytes while rows move.

    ``once`` states that each claim has one row.
    """
    stg, dim_members = (df.withColumn("member_id", packed("member_id")) for df in (stg, dim_members))
    hot = {**hot, "member_id": [packed_text(key) for key in hot.get("member_id", ())]}
    latest = stg if once else latest_per_key(stg, newest="run_date")
    return int_claims(latest, dim_members, dim_providers, as_of, hot).withColumn("member_id", unpacked("member_id"))


def int_schema(stg: DataFrame) -> T.StructType:
    return T.StructType(
        stg.schema.fields + DIM_MEMBERS.fields[1:] + DIM_PROVIDERS.fields[1:] + CATEGORIZED.fields
    )


def publish_views(
    fact: DataFrame,
    dim_members: DataFrame,
    dim_providers: DataFrame,
    as_of: dt.datetime | str | None = None,
) -> None:
    """The three models as temporary views over ``fact``, computed when queried."""
    today = None if as_of is None else str(as_of)[:10]
    stg = stg_claims(fact)
    # The stored model keeps the latest run of a claim; so does the view.
    latest = latest_per_key(stg, newest="run_date")
    hot = hot_keys(fact, "member_id", "provider_npi")
    enriched = int_claims(latest, dim_members, dim_providers, today, hot)
    stg.createOrReplaceTempView("stg_claims")
    enriched.createOrReplaceTempView("int_claims_enriched")
    if repeats(dim_members, "member_id") or repeats(dim_providers, "provider_npi"):
        mart = monthly_summary(enriched, as_of)
    else:
        # Each claim is one row, and no measure reads the providers' attributes. One claim of
        # each member and group is marked where the members joined.
        marked = mark_first(int_claims(latest, dim_members, None, today, hot), "first")
        narrow = int_claims(latest, None, None, today)
        mart = monthly_summary(marked, as_of, claims_unique=True, member_first="first", narrow=narrow)
    mart.createOrReplaceTempView("mart_claims_summary")


@releasing
def repeats(dim: DataFrame, key: str) -> bool:
    """Whether a dimension has a key twice; the rows that look it up would be multiplied."""
    return not duplicates(dim.select(key), key).isEmpty()


def run_models(
    spark: SparkSession,
    fact: DataFrame,
    dim_members: DataFrame,
    dim_providers: DataFrame,
    int_path: str,
    mart_path: str,
    as_of: dt.datetime | str | None = None,
    inclusive: bool = False,
    run_date: str | None = None,
    rebuild_mart: bool = False,
) -> list[str] | None:
    """Merge new fact rows into the enriched claims and rebuild the mart's changed months.

    With ``run_date`` the batch is that run's slice, so a run that is corrected or
    loaded late arrives too; rows of a newer run are left alone. Without, it is all
    runs past the greatest one that the enriched claims hold. A claim sent in several
    runs has one fact row per run: the latest run in the batch goes into the merge.
    Both dimensions must be unique on their key. The mart is partitioned by month, and
    so are the enriched claims: only months that changed are aggregated, unless
    ``rebuild_mart`` asks for all. Returns their folders, or None for all.
    """
    schema = merge_enriched(spark, fact, dim_members, dim_providers, int_path, as_of, inclusive, run_date)
    return refresh_mart(spark, int_path, mart_path, schema, as_of, rebuild_mart)


@releasing
def merge_enriched(
    spark: SparkSession,
    fact: DataFrame,
    dim_members: DataFrame,
    dim_providers: DataFrame,
    int_path: str,
    as_of: dt.datetime | str | None = None,
    inclusive: bool = False,
    run_date: str | None = None,
) -> T.StructType:
    """The merge alone; the months it changes have its version, by which the mart finds them."""
    require_unique(dim_members, "member_id", "dim_members")
    require_unique(dim_providers, "provider_npi", "dim_providers")
    stg = stg_claims(fact)
    schema = int_schema(stg)
    if run_date is not None:
        fresh = stg.where(F.col("run_date") == run_date)
    else:
        fresh = past_value(stg, F.lit(stored_mark(spark, int_path)), inclusive=inclusive, all_when_empty=True)
    today = None if as_of is None else str(as_of)[:10]
    # A run out of the conformed claims has each claim once, which its ids alone tell.
    repeated = duplicates(fresh.select("claim_id")).take(1)
    hot = hot_keys(fresh, "member_id", "provider_npi")
    batch = int_claims_packed(fresh, dim_members, dim_providers, today, hot, once=not repeated)
    figures = {"rows": F.count(F.lit(1)), "mark": F.max("run_date")}
    passes = versions.passes_for(fresh.count())
    writers.upsert(spark, batch, int_path, schema, only_if_newer="run_date", figures=figures, passes=passes)
    return schema


def stored_mark(spark: SparkSession, int_path: str) -> str | None:
    """The greatest run date in the enriched claims, from their record."""
    marks = [row.mark for row in versions.ledger(spark, int_path, mark="string").collect() if row.mark is not None]
    return max(marks, default=None)


@releasing
def refresh_mart(
    spark: SparkSession,
    int_path: str,
    mart_path: str,
    schema: T.StructType,
    as_of: dt.datetime | str | None = None,
    rebuild: bool = False,
) -> list[str] | None:
    """Aggregate the months of the enriched claims that the mart has not seen, or all (None).

    The mart's record tells which record of the enriched claims it has seen, so months of
    a call that was interrupted after its merge are made up for by the next call.
    """
    record, held = versions.current(spark, int_path), versions.current(spark, mart_path)
    source = int_path, record.number

    def parts(names: Collection[str]) -> list[DataFrame]:
        # A month's groups are in its own partition, so some months are aggregated at a time.
        rows = sum(record.figures.get(name, {}).get("rows", 0) for name in names)
        bases = [versions.read(spark, int_path, schema, record, group) for group in versions.dealt(names, rows)]
        # The merge key is unique in the stored table, so distinct claims are plain counts.
        return [monthly_summary(base, as_of, claims_unique=True, stored=True) for base in bases]

    if rebuild or not held.number:
        first, *more = parts(record.parts)
        writers.write_mart(first, mart_path, source, more)
        return None
    newer, gone = versions.unseen(record, held, int_path)
    first, *more = parts(newer)
    writers.write_mart_months(first, mart_path, [*newer, *gone], source, more)
    return newer
