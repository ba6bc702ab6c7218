"""One query per operator over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimforge import functions as fn
from claimforge.functions.amounts import stored_ratio
from claimforge.functions.privacy import packed, unpacked
from claimforge.operators import cleaning, enrich, merge, quality, scd2, summary
from claimforge.operators.latest import latest_per_key
from claimforge.operators.lookup import lookup
from claimforge.plans import measures, models
from claimforge.plans.daily import SEVERITY, Layout, run_day
from claimforge.plans.extract import quarantine_report as count_rules
from claimforge.plans.extract import run_extract, stage
from claimforge.plans.load import fact_rows, ledger_figures, run_ledger, run_load
from claimforge.plans.transform import run_transform
from claimforge.schemas import CONFORMED_CLAIMS, CONFORMED_PARTITION, MART_KEYS
from claimforge.session import releasing, scratch_dir
from claimforge.sources import readers, versions, writers
from claimforge.testtables import claims as src

# Pinned clock and run, so that results do not depend on the day they are computed.
RUN_DATE = "2002-01-01"
NOW = "2002-01-01 06:00:00"
LOADED_RUN = "1998-06-15"
HALF = "2000-01-01"
LATE_RUN = "2002-01-02"
TOKEN_KEY = "k1"
# Rows of a landed file: some 60 MB of CSV text.
LANDED_ROWS = 500_000

Query = Callable[[SparkSession, str], DataFrame]
CATALOG: dict[str, Query] = {}


def query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain_types(build(spark, sf_dir))

    CATALOG[build.__name__] = run
    return build


def plain_types(df: DataFrame) -> DataFrame:
    """Types every engine hands over alike: long, double, text, boolean."""
    columns = []
    for field in df.schema.fields:
        col, kind = F.col(field.name), field.dataType
        if isinstance(kind, T.DecimalType):
            col = col.cast("double")
        elif isinstance(kind, (T.IntegerType, T.ShortType, T.ByteType)):
            col = col.cast("long")
        elif isinstance(kind, T.DateType):
            col = col.cast("string")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            col = F.date_format(col, "yyyy-MM-dd HH:mm:ss")
        columns.append(col.alias(field.name))
    return df.select(*columns)


# What the measures read besides the keys.
MEASURED = [
    "claim_id",
    "member_id",
    "provider_npi",
    "billed_amount",
    "allowed_amount",
    "paid_amount",
    "denied_flag",
    "high_cost_flag",
    "out_of_network_flag",
    "length_of_stay_days",
    "cost_ratio",
    "risk_score",
]

# Shared stages ------------------------------------------------------------


def cleaned(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return cleaning.drop_negative(cleaning.require(src.claims(spark, sf_dir, *columns)))


def latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cleaned(spark, sf_dir, *src.BATCH, *src.TIES)
    return latest_per_key(rows, ties=src.TIES).drop(*src.TIES)


def masked(rows: DataFrame) -> DataFrame:
    """Masked members as bytes, half as long while rows move."""
    return cleaning.mask_members(rows).withColumn("member_id", packed("member_id"))


def spelled(rows: DataFrame) -> DataFrame:
    return rows.withColumn("member_id", unpacked("member_id"))


def heavy_keys(spark: SparkSession, sf_dir: str) -> dict[str, list]:
    """Heavy keys of cleaned claims, which all have a member; members clear."""
    hot = src.heavy_claim_keys(spark, sf_dir)
    return hot | {"member_id": [key for key in hot["member_id"] if key is not None]}


def attached(spark: SparkSession, sf_dir: str, rows: DataFrame) -> DataFrame:
    """Claims with reference attributes and derived columns.

    Members are masked by the callers, after the last join by member: a digest is 32 bytes that
    no codec makes shorter, and every shuffle of claims would carry it.
    """
    reference = src.members(spark, sf_dir), src.providers(spark, sf_dir)
    return enrich.derive(enrich.attach_reference(rows, *reference, heavy_keys(spark, sf_dir)))


def conformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deduplicated, enriched claims of all runs; members clear."""
    return attached(spark, sf_dir, latest(spark, sf_dir))


def staged_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.stg_claims(fact_rows(conformed(spark, sf_dir)))


def all_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact rows with all copies of a claim, as several runs send them; members as bytes."""
    return fact_rows(masked(attached(spark, sf_dir, cleaned(spark, sf_dir, *src.BATCH))))


def with_copies(spark: SparkSession, sf_dir: str, *measures: str) -> DataFrame:
    """Measures over all copies: distinct counts differ from rows, rates may pass 100."""
    facts = fact_rows(attached(spark, sf_dir, cleaned(spark, sf_dir, *src.BATCH)))
    rows = models.int_claims(models.stg_claims(facts), None, None, RUN_DATE)
    if "unique_members" not in measures:
        return summary.summarize(masked(rows), measures=measures)
    # One claim of each member and group is marked where the members joined: their count moves nothing.
    marked = masked(summary.mark_first(rows, "first"))
    return summary.summarize(marked, measures=measures, member_first="first")


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.int_claims(
        staged_facts(spark, sf_dir),
        src.dim_members(spark, sf_dir),
        src.dim_providers(spark, sf_dir),
        RUN_DATE,
        heavy_keys(spark, sf_dir),
    )


def mart_base(spark: SparkSession, sf_dir: str, risk: bool, first_by: Sequence[str] = ()) -> DataFrame:
    """The enriched claims as far as the mart reads them: no provider dimension.

    ``first_by`` marks one claim of each member and group in a column ``first``.
    """
    dim = src.dim_members(spark, sf_dir) if risk else None
    hot = heavy_keys(spark, sf_dir)
    rows = models.int_claims(staged_facts(spark, sf_dir), dim, None, RUN_DATE, hot)
    return masked(summary.mark_first(rows, "first", first_by) if first_by else rows)


def measured(spark: SparkSession, sf_dir: str, *measures: str) -> DataFrame:
    # latest_per_key made claim_id unique, so the distinct claims are a plain count.
    base = mart_base(spark, sf_dir, "avg_member_risk_score" in measures)
    if summary.MEDIAN in measures:
        base = stored(spark, base.select(*MART_KEYS, "claim_id", "paid_amount"), "int")
    return summary.summarize(base, measures=measures, claims_unique=True)


@releasing
def stored(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """A table in the shared folder, for rows that a query reads more than once."""
    path = scratch_dir(spark, label)
    df.write.options(**writers.PACKED).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The enriched claims are a table of their own, so the mart's two scans share one build."""
    base = mart_base(spark, sf_dir, True, MART_KEYS).select(*MART_KEYS, *MEASURED, "first")
    return summary.monthly_summary(stored(spark, base, "int"), NOW, claims_unique=True, stored=True, member_first="first")


def batch_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["claim_id", "service_date", "paid_amount", "ingested_at", "run_date", *src.TIES]
    rows = src.claims(spark, sf_dir, *names)
    return rows.withColumns(
        {"service_year": F.year("service_date"), "service_month": F.month("service_date")}
    )


def halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Latest claims served before and from a day on; many ids are in both."""
    rows = batch_rows(spark, sf_dir)
    early = F.coalesce(F.col("service_date") < HALF, F.lit(False))
    old, new = (
        latest_per_key(rows.where(part), ties=src.TIES).drop(*src.TIES) for part in (early, ~early)
    )
    return old, new


@releasing
def landed(
    spark: SparkSession,
    sf_dir: str,
    root: str,
    fmt: str = "csv",
    rows: DataFrame | None = None,
    run_date: str = RUN_DATE,
) -> str:
    """Raw claims as the files of one run; the folder holding them.

    Files are compressed, which a reader takes whole, and so are bounded in rows.
    """
    path = readers.raw_path(root, run_date)
    rows = src.raw_claims(spark, sf_dir) if rows is None else rows
    writer = rows.write.mode("overwrite").options(compression="gzip", maxRecordsPerFile=LANDED_ROWS)
    if fmt == "csv":
        writer = writer.options(
            header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
        )
    writer.format(fmt).save(path)
    return path


# Sources and sinks --------------------------------------------------------


@query
def scan_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.raw_claims(spark, landed(spark, sf_dir, scratch_dir(spark, "csv")))


@query
def scan_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = landed(spark, sf_dir, scratch_dir(spark, "json"), "json")
    return readers.raw_claims(spark, path, "json")


def staged_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(src.raw_claims(spark, sf_dir), RUN_DATE, "test", NOW)


@query
def staging_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = readers.staging_path(scratch_dir(spark, "staging"), RUN_DATE)
    amounts = {
        name: F.col(name).cast("double")
        for name in ("billed_amount", "allowed_amount", "paid_amount")
    }
    writers.write_staging(staged_raw(spark, sf_dir).withColumns(amounts), path)
    return readers.staged_claims(spark, path)


@query
def staging_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "staging-month")
    writers.write_staging_by_month(staged_raw(spark, sf_dir), path)
    return spark.read.parquet(path).groupBy("service_month").agg(
        F.count(F.lit(1)).alias("claims"), F.sum("paid_amount").alias("paid")
    )


@query
def dim_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "members")
    # A file with more columns, in another order, than the reader asks for.
    rows = src.members(spark, sf_dir, whole=True).withColumn("extra", F.lit(1))
    rows.select(*reversed(rows.columns)).write.parquet(path)
    return readers.members(spark, path)


@query
def dim_providers(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "providers")
    rows = src.providers(spark, sf_dir, whole=True).withColumn("extra", F.lit(1))
    rows.select(*reversed(rows.columns)).write.parquet(path)
    return readers.providers(spark, path)


# Row operators ------------------------------------------------------------


@query
def filter_required_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.require(src.claims(spark, sf_dir, "claim_id", "member_id"))


@query
def filter_required_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = src.claims(spark, sf_dir, "claim_id", "service_text", "billed_amount")
    typed = cleaning.type_dates(rows.withColumnRenamed("service_text", "service_date"), "service_date")
    return cleaning.require(typed, *cleaning.REQUIRED_FIELDS)


@query
def filter_non_negative(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.drop_negative(
        src.claims(spark, sf_dir, "claim_id", "billed_amount", "paid_amount")
    )


@query
def parse_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = src.claims(spark, sf_dir, "claim_id", "service_text", "discharge_text")
    return cleaning.type_dates(rows, "service_text", "discharge_text")


@query
def audit_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.stamp(src.claims(spark, sf_dir, "claim_id"), RUN_DATE, "test", NOW)


@query
def pii_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.mask_members(src.claims(spark, sf_dir, "claim_id", "member_id"))


@query
def pii_mask_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = src.claims(spark, sf_dir, "claim_id", "provider_npi", "service_date", "billed_amount")
    return rows.select(
        "claim_id",
        *[fn.digest(n).alias(n) for n in ("provider_npi", "service_date", "billed_amount")],
    )


@query
def tokenize_npi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.tokenize_providers(
        src.claims(spark, sf_dir, "claim_id", "provider_npi"), TOKEN_KEY
    )


@query
def normalize_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["diagnosis_code", "procedure_code", "claim_status"]
    rows = src.claims(spark, sf_dir, "claim_id", *names, "claim_type")
    return rows.select(
        "claim_id",
        *[fn.fold_upper(name).alias(name) for name in names],
        fn.fold_lower("claim_type").alias("claim_type"),
    )


@query
def standardize_claim_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = src.claims(spark, sf_dir, "claim_id", "claim_type", "claim_status")
    sent = F.when(F.col("claim_status") == "VOID", "hospice").otherwise(
        F.concat(F.lit(" "), "claim_type", F.lit(" "))
    )
    return rows.withColumn("sent", sent).select(
        "claim_id", "sent", fn.standard_claim_type("sent").alias("standard")
    )


@query
def codes_to_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = src.claims(spark, sf_dir, "claim_id", "diagnosis_code", "procedure_code")
    listed = rows.withColumn(
        "sent", F.concat_ws(",", "diagnosis_code", F.lit(" "), "procedure_code")
    ).withColumn("codes", fn.code_list("sent"))
    return listed.select(
        "claim_id",
        F.size("codes").alias("n"),
        F.get("codes", F.lit(0)).alias("first"),
        F.array_join("codes", "|").alias("codes"),
    )


@query
def length_of_stay(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = src.claims(spark, sf_dir, "claim_id", "service_date", "discharge_date")
    return rows.withColumn("length_of_stay_days", fn.day_span("service_date", "discharge_date"))


@query
def days_since_service(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = src.claims(spark, sf_dir, "claim_id", "service_date")
    return rows.withColumn("days_since_service", fn.days_since("service_date", RUN_DATE))


@query
def days_to_payment(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = src.claims(spark, sf_dir, "claim_id", "service_date", "discharge_date", "paid_amount")
    wait = 10 + F.pmod(F.floor("paid_amount"), F.lit(20)).cast("int")
    paid_on = F.when(F.col("paid_amount") > 0, F.date_add("service_date", wait))
    return rows.withColumn("payment_date", paid_on).select(
        "claim_id",
        "payment_date",
        fn.day_span("service_date", "payment_date").alias("days_to_payment"),
    )


@query
def service_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = src.claims(spark, sf_dir, "claim_id", "service_date")
    return rows.select(
        "claim_id",
        F.year("service_date").alias("service_year"),
        F.month("service_date").alias("service_month"),
    )


@query
def cost_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = src.claims(spark, sf_dir, "claim_id", "paid_amount", "billed_amount")
    valued = rows.withColumn("cost_ratio", fn.ratio("paid_amount", "billed_amount"))
    return valued.withColumn("stored_ratio", stored_ratio("cost_ratio"))


@query
def allowed_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = src.claims(spark, sf_dir, "claim_id", "allowed_amount", "billed_amount")
    return rows.withColumn("allowed_ratio", fn.ratio("allowed_amount", "billed_amount"))


@query
def business_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = src.claims(spark, sf_dir, "claim_id", "provider_npi", "claim_status", "paid_amount")
    joined = lookup(
        rows,
        src.providers(spark, sf_dir).select("provider_npi", "network_flag"),
        "provider_npi",
        src.hot_claim_keys(spark, sf_dir)["provider_npi"],
        ("claim_id", "provider_npi"),
    )
    return joined.select(
        "claim_id",
        "provider_npi",
        fn.is_denied().alias("denied_flag"),
        fn.is_high_cost().alias("high_cost_flag"),
        fn.is_out_of_network().alias("out_of_network_flag"),
    )


@query
def claim_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["claim_id", "member_id", "provider_npi"]
    rows = cleaned(spark, sf_dir, *keys, "billed_amount", "paid_amount", "claim_type")
    joined = lookup(
        rows,
        src.providers(spark, sf_dir).select("provider_npi", "network_flag"),
        "provider_npi",
        src.hot_claim_keys(spark, sf_dir)["provider_npi"],
        ("claim_id", "provider_npi"),
    )
    flagged = joined.withColumns(
        {"high_cost_flag": fn.is_high_cost(), "out_of_network_flag": fn.is_out_of_network()}
    )
    return flagged.select("claim_id", "claim_type", fn.category().alias("claim_category"))


# Joins, latest, merge -----------------------------------------------------


@query
def enrich_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = src.claims(spark, sf_dir, "claim_id", "member_id", "provider_npi")
    return enrich.attach_reference(
        cleaning.mask_members(rows),
        cleaning.mask_members(src.members(spark, sf_dir)),
        src.providers(spark, sf_dir),
        src.hot_claim_keys(spark, sf_dir),
    )


@query
def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest(spark, sf_dir)


def upserted(
    spark: SparkSession, label: str, *batches: DataFrame, newer: str | None = None
) -> DataFrame:
    path = scratch_dir(spark, label)
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in batches[0].schema.fields])
    for batch in batches:
        writers.upsert(spark, batch, path, schema, only_if_newer=newer)
    return versions.read(spark, path, schema)


@query
def upsert_initial(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = latest_per_key(batch_rows(spark, sf_dir), ties=src.TIES).drop(*src.TIES)
    return upserted(spark, "upsert-initial", rows)


@query
def upsert_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upserted(spark, "upsert-merge", *halves(spark, sf_dir))


@query
def upsert_only_if_newer(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = halves(spark, sf_dir)
    return upserted(spark, "upsert-newer", new, old, newer="ingested_at")


@query
def merge_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    actions = merge.merge_actions(*halves(spark, sf_dir))
    return actions.groupBy("action").agg(F.count(F.lit(1)).alias("claims"))


@query
def incremental_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mark comes from the record of a stored table, kept per month."""
    rows = src.claims(spark, sf_dir, "claim_id", "run_date")
    path = scratch_dir(spark, "mark")
    target = rows.where(F.col("run_date") < HALF).withColumn("month", F.substring("run_date", 1, 7))
    writers.load_slices(target, path, ["month"], {"mark": F.max("run_date")})
    return merge.past_value(rows, F.lit(models.stored_mark(spark, path)))


@query
def load_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "load")
    stored = cleaning.mask_members(conformed(spark, sf_dir)).withColumn("env", F.lit("test"))
    passes = versions.passes_for(src.table(spark, sf_dir, "lineitem").count())
    writers.upsert(spark, doubles(stored), f"{root}/conformed", CONFORMED_CLAIMS, passes=passes)
    run_load(spark, f"{root}/conformed", f"{root}/fact", LOADED_RUN)
    return readers.fact_claims(spark, f"{root}/fact")


def doubles(rows: DataFrame) -> DataFrame:
    """Amounts as the raw layer types them."""
    names = ("billed_amount", "allowed_amount", "paid_amount")
    return rows.withColumns({name: F.col(name).cast("double") for name in names})


@query
def int_incremental_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two builds of the enriched claims; the second sees only the runs after the first."""
    root = scratch_dir(spark, "int")
    fact = stored(spark, spelled(all_facts(spark, sf_dir)), "fact")
    dims = (
        cleaning.mask_members(src.dim_members(spark, sf_dir)),
        src.dim_providers(spark, sf_dir),
    )
    for part in (fact.where(F.col("run_date") < HALF), fact):
        models.run_models(spark, part, *dims, f"{root}/int", f"{root}/mart", NOW)
    schema = models.int_schema(models.stg_claims(fact))
    return versions.read(spark, f"{root}/int", schema).select(
        "claim_id",
        "run_date",
        "claim_category",
        "days_since_service",
        "state",
        "age_band",
        "provider_tier",
    )


# Models -------------------------------------------------------------------


@query
def stg_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.mask_members(staged_facts(spark, sf_dir))


@query
def int_claims_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.mask_members(enriched(spark, sf_dir))


@query
def agg_distinct_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_copies(spark, sf_dir, "total_claims", "unique_members", "unique_providers")


@query
def agg_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measured(spark, sf_dir, "total_billed", "total_allowed", "total_paid")


@query
def agg_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["avg_paid_per_claim", "avg_los_days", "avg_cost_ratio", "avg_member_risk_score"]
    return measured(spark, sf_dir, *names)


@query
def agg_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measured(spark, sf_dir, "median_paid_per_claim")


def in_three_batches(spark: SparkSession, sf_dir: str, path: str, *columns: str) -> Iterator[T.StructType]:
    """The enriched claims by three upserts; after each, the table's schema.

    The first sends two thirds with wrong amounts, half of them to wrong months; the
    second and third send every claim once as it is.
    """
    names = [*MART_KEYS, "claim_id", "paid_amount", "run_date", *columns]
    rows = stored(spark, spelled(mart_base(spark, sf_dir, False)).select(*names), "int")
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema.fields])
    part = F.pmod(F.xxhash64("claim_id"), F.lit(6))
    moved = F.when(part % 2 == 0, 13 - F.col("service_month")).otherwise(F.col("service_month"))
    wrong = rows.withColumns({"paid_amount": F.col("paid_amount") + 10, "service_month": moved.cast("int")})
    for batch in (wrong.where(part < 4), rows.where(part >= 2), rows.where(part < 2)):
        writers.upsert(spark, batch, path, schema, change_columns=measures.FOLLOWED)
        yield schema


@query
def agg_median_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The median located in counts that three batches added to and took from."""
    root = scratch_dir(spark, "median")
    for schema in in_three_batches(spark, sf_dir, f"{root}/int"):
        measures.refresh_medians(spark, f"{root}/int", schema, f"{root}/cents", f"{root}/medians")
    found = versions.read(spark, f"{root}/medians", measures.median_schema(schema))
    return found.select(*MART_KEYS, F.round("median", 4).alias("median_paid_per_claim"))


@query
def agg_distinct_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members and providers by plan and year, from monthly bitmaps kept over three batches."""
    root = scratch_dir(spark, "distinct")
    for schema in in_three_batches(spark, sf_dir, f"{root}/int", "member_id", "provider_npi"):
        measures.refresh_distinct(spark, f"{root}/int", schema, f"{root}/distinct")
    found = measures.distinct_counts(spark, f"{root}/distinct", schema, ["plan_id", "service_year"])
    return found.withColumnsRenamed({"distinct_member_id": "unique_members", "distinct_provider_npi": "unique_providers"})


@query
def agg_conditional_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measured(spark, sf_dir, "denied_claims", "high_cost_claims", "out_of_network_claims")


@query
def agg_denial_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_copies(spark, sf_dir, "denial_rate_pct")


@query
def mart_claims_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mart(spark, sf_dir)


@query
def mart_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "mart")
    writers.write_mart(mart(spark, sf_dir), path)
    return readers.mart_claims(spark, path)


@query
def model_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart view over facts with all copies; it agrees with the stored models."""
    fact = stored(spark, spelled(all_facts(spark, sf_dir)), "fact")
    dims = cleaning.mask_members(src.dim_members(spark, sf_dir)), src.dim_providers(spark, sf_dir)
    models.publish_views(fact, *dims, NOW)
    return spark.table("mart_claims_summary")


@query
def mart_payer_type_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = mart_base(spark, sf_dir, True, summary.PAYER_KEYS).select(*MART_KEYS, *MEASURED, "first")
    return summary.payer_summary(stored(spark, base, "int"), claims_unique=True, stored=True, member_first="first")


# Data checks --------------------------------------------------------------

CHECKED = [
    "claim_id",
    "member_id",
    "billed_amount",
    "paid_amount",
    "claim_status",
    "claim_type",
]


def failures(spark: SparkSession, sf_dir: str, rule: str) -> DataFrame:
    checks = [check for check in quality.claim_checks() if check.rule == rule]
    columns = [name for name in CHECKED if name in {check.column for check in checks}]
    return quality.count_failures(src.claims(spark, sf_dir, *columns), checks)


@query
def validation_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.validation_counts(
        src.claims(spark, sf_dir, "claim_id", "member_id", "billed_amount", "paid_amount")
    )


@query
def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicates(src.claims(spark, sf_dir, "claim_id"))


@query
def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return failures(spark, sf_dir, "not_null")


@query
def dq_accepted_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return failures(spark, sf_dir, "accepted_range")


@query
def dq_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return failures(spark, sf_dir, "accepted_values")


@query
def dq_mart_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = with_copies(spark, sf_dir, "total_claims", "denial_rate_pct")
    return quality.count_failures(rates, quality.mart_checks())


@query
def dq_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "freshness")
    claims = src.claims(spark, sf_dir, "claim_id", "ingested_at")
    claims = claims.withColumn("year", F.coalesce(F.year("ingested_at"), F.lit(0)))
    writers.load_slices(claims, path, ["year"], ledger_figures())
    rows = run_ledger(spark, path).withColumnRenamed("newest", "ingested_at")
    # 12, 30 and 60 hours after the last day of the tables.
    moments = ("2001-11-04 12:00:00", "2001-11-05 06:00:00", "2001-11-06 12:00:00")
    first, *rest = [
        quality.freshness(rows, moment).withColumn("as_of", F.lit(moment)) for moment in moments
    ]
    for other in rest:
        first = first.unionByName(other)
    return first


@query
def dq_row_count_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "trend")
    events = src.table(spark, sf_dir, "events").withColumn("run_date", F.col("ts").cast("date").cast("string"))
    writers.load_slices(events, path, ["run_date"], {"rows": F.count(F.lit(1))})
    counts = run_ledger(spark, path).select(F.col("run_date").cast("date").alias("day"), "rows")
    return quality.row_count_trend(counts, min_share=0.95)


# Member history -----------------------------------------------------------

HISTORY = {
    "key": "member_id",
    "day": "change_day",
    "attributes": ["plan_type"],
    "order": "o_orderkey",
}


@query
def scd2_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2.build_history(src.member_changes(spark, sf_dir), **HISTORY)


@query
def scd2_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches by order key: the second holds changes before, between and after the first's."""
    changes = src.member_changes(spark, sf_dir)
    second = F.coalesce(F.col("o_orderkey") % 3 == 0, F.lit(False))
    log = changes.where(~second)
    first = stored(spark, scd2.build_history(log, **HISTORY), "history")
    return scd2.apply_changes(first, log, changes.where(second), **HISTORY)


@query
def point_in_time_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = src.claims(spark, sf_dir, "claim_id", "member_id", "service_date")
    history = stored(
        spark, scd2.build_history(src.member_changes(spark, sf_dir), **HISTORY), "history"
    )
    apart = ("claim_id", "service_date")
    # Claims without a member are spread; those of a member are by year.
    return scd2.as_of_join(facts, history, "member_id", "service_date", apart, [None])


# Whole jobs ---------------------------------------------------------------


@query
def extract_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "extract")
    landed(spark, sf_dir, f"{root}/raw")
    run_extract(spark, f"{root}/raw", f"{root}/staging", RUN_DATE, "test", NOW)
    return readers.staged_claims(spark, readers.staging_path(f"{root}/staging", RUN_DATE))


@query
def transform_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "transform")
    writers.write_staging(
        doubles(staged_raw(spark, sf_dir)), readers.staging_path(f"{root}/staging", RUN_DATE)
    )
    members = cleaning.mask_members(src.members(spark, sf_dir))
    providers = src.providers(spark, sf_dir)
    run_transform(spark, f"{root}/staging", f"{root}/conformed", RUN_DATE, members, providers)
    return readers.conformed_claims(spark, f"{root}/conformed")


@query
def extract_odd_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed files with NaN, Infinity and amounts beyond the money type: dropped and counted."""
    root = scratch_dir(spark, "odd")
    texts = {"service_date": "service_text", "discharge_date": "discharge_text"}
    rows = src.claims(spark, sf_dir, *[texts.get(name, name) for name in src.RAW], "quantity")
    rows = rows.withColumnsRenamed({text: name for name, text in texts.items()})
    odd = F.create_map(*[F.lit(x) for x in (6, "NaN", 7, "Infinity", 8, "1e20")])
    billed = F.coalesce(F.get(F.array(odd), F.lit(0))[F.col("quantity").cast("int")], F.col("billed_amount").cast("string"))
    landed(spark, sf_dir, f"{root}/raw", rows=rows.withColumn("billed_amount", billed).select(*src.RAW))
    report = run_extract(spark, f"{root}/raw", f"{root}/staging", RUN_DATE, "test", NOW)
    staged = readers.staged_claims(spark, readers.staging_path(f"{root}/staging", RUN_DATE))
    totals = staged.agg(F.count(F.lit(1)).alias("staged"), F.max("billed_amount").alias("most_billed"))
    return totals.select("*", *[F.lit(count).cast("long").alias(name) for name, count in report.items()])


def landed_odd(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Files with cells that are no amounts, no dates and no claim types."""
    texts = {"service_date": "service_text", "discharge_date": "discharge_text"}
    rows = src.claims(spark, sf_dir, *[texts.get(name, name) for name in src.RAW], "quantity")
    rows = rows.withColumnsRenamed({text: name for name, text in texts.items()})

    def odd(name: str, *cells: object) -> Column:
        sent = F.create_map(*[F.lit(x) for x in cells])
        return F.coalesce(F.get(F.array(sent), F.lit(0))[F.col("quantity").cast("int")], F.col(name).cast("string"))

    changed = {
        "billed_amount": odd("billed_amount", 6, "NaN", 7, "Infinity", 8, "1e20", 9, "12x"),
        "paid_amount": odd("paid_amount", 9, "?", 10, "-0.5"),
        "allowed_amount": odd("allowed_amount", 11, "much"),
        "claim_type": F.when(F.col("claim_status") == "VOID", "hospice").otherwise(F.col("claim_type")),
    }
    landed(spark, sf_dir, root, rows=rows.withColumns(changed).select(*src.RAW))


@query
def quarantine_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected and noted rows by rule, beside the extract's own count of dropped rows."""
    root = scratch_dir(spark, "quarantine")
    landed_odd(spark, sf_dir, f"{root}/raw")
    report = run_extract(
        spark, f"{root}/raw", f"{root}/staging", RUN_DATE, "test", NOW, quarantine_root=f"{root}/quarantine"
    )
    held = f"{root}/quarantine/run_date={RUN_DATE}"
    found = count_rules(spark, readers.staging_path(f"{root}/staging", RUN_DATE), held)
    kept = readers.rejected_claims(spark, held).agg(F.count(F.lit(1)).alias("rows"))
    total = kept.select(F.lit("rejected").alias("route"), F.lit("any").alias("rule"), F.lit("any").alias("column_name"), "rows")
    return found.unionByName(total).withColumn("rows_dropped", F.lit(report["rows_dropped"]).cast("long"))


@query
def quarantined_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rejected rows themselves, with the cells as they were sent."""
    root = scratch_dir(spark, "quarantine")
    landed_odd(spark, sf_dir, f"{root}/raw")
    run_extract(spark, f"{root}/raw", f"{root}/staging", RUN_DATE, "test", NOW, quarantine_root=f"{root}/quarantine")
    rows = readers.rejected_claims(spark, f"{root}/quarantine/run_date={RUN_DATE}")
    rules = F.transform("rejected", lambda b: F.concat_ws(" ", b.rule, b.column_name, F.coalesce(b.cell, F.lit("-"))))
    return rows.select("claim_id", "member_id", "claim_type", F.array_join(F.array_sort(rules), "; ").alias("rules"), "sent.service_date")


def new_layout(spark: SparkSession) -> Layout:
    root = scratch_dir(spark, "day")
    folders = ("raw", "staging", "conformed", "fact", "int", "mart", "checks")
    return Layout(*[f"{root}/{folder}" for folder in folders])


def run_one(spark: SparkSession, sf_dir: str, layout: Layout, run_date: str = RUN_DATE) -> None:
    """One run through all steps. The test tables hold a claim type that is not accepted."""
    run_day(
        spark,
        layout,
        run_date,
        src.members(spark, sf_dir),
        src.providers(spark, sf_dir),
        src.dim_members(spark, sf_dir),
        src.dim_providers(spark, sf_dir),
        "test",
        NOW,
        severity=SEVERITY | {"accepted_values": "warn"},
    )


def one_day(spark: SparkSession, sf_dir: str) -> Layout:
    layout = new_layout(spark)
    landed(spark, sf_dir, layout.raw)
    run_one(spark, sf_dir, layout)
    return layout


@query
def daily_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.mart_claims(spark, one_day(spark, sf_dir).mart)


@query
def daily_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day with wrong amounts and missing claims, landed again and repeated."""
    layout = new_layout(spark)
    rows = src.raw_claims(spark, sf_dir)
    wrong = rows.where(F.coalesce(F.col("claim_type") != "dental", F.lit(True)))
    landed(spark, sf_dir, layout.raw, rows=wrong.withColumn("paid_amount", F.col("paid_amount") * 2))
    run_one(spark, sf_dir, layout)
    landed(spark, sf_dir, layout.raw, rows=rows)
    run_one(spark, sf_dir, layout)
    return readers.mart_claims(spark, layout.mart)


@query
def daily_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that comes after a later one: it adds its claims and replaces no newer row."""
    layout = new_layout(spark)
    rows = src.raw_claims(spark, sf_dir)
    # Both halves land, each in its own run; the later run first.
    early = F.coalesce(F.col("service_date") < HALF, F.lit(False))
    for run_date, part in ((LATE_RUN, early), (RUN_DATE, ~early)):
        landed(spark, sf_dir, layout.raw, rows=rows.where(part), run_date=run_date)
        run_one(spark, sf_dir, layout, run_date)
    return readers.mart_claims(spark, layout.mart)


@query
def daily_interrupted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day whose claims move to other months: lost in a write, lost before the mart, and repeated."""
    layout = new_layout(spark)
    rows = src.raw_claims(spark, sf_dir)
    early = F.coalesce(F.col("service_date") < HALF, F.lit(False))
    landed(spark, sf_dir, layout.raw, rows=rows.where(~early))
    run_one(spark, sf_dir, layout)
    landed(spark, sf_dir, layout.raw, rows=rows.where(early), run_date=LATE_RUN)
    run_extract(spark, layout.raw, layout.staging, LATE_RUN, "test", NOW)
    reference = cleaning.mask_members(src.members(spark, sf_dir)), src.providers(spark, sf_dir)
    run_transform(spark, layout.staging, layout.conformed, LATE_RUN, *reference, "run_date")
    run_load(spark, layout.conformed, layout.fact, LATE_RUN)
    fact = readers.fact_claims(spark, layout.fact)
    dims = cleaning.mask_members(src.dim_members(spark, sf_dir)), src.dim_providers(spark, sf_dir)
    # Folders of a merge that never came to its switch.
    record = versions.current(spark, layout.enriched)
    schema = models.int_schema(models.stg_claims(fact))
    half_done = versions.read(spark, layout.enriched, schema, record).where("service_month < 6")
    versions.write(half_done, layout.enriched, record, CONFORMED_PARTITION)
    models.merge_enriched(spark, fact, *dims, layout.enriched, NOW, run_date=LATE_RUN)
    run_one(spark, sf_dir, layout, LATE_RUN)
    return readers.mart_claims(spark, layout.mart)


@query
def load_fact_emptied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All claims of a loaded run are resubmitted with another: the first one's slice goes."""
    root = scratch_dir(spark, "emptied")
    rows = stored(spark, doubles(cleaning.mask_members(conformed(spark, sf_dir)).withColumn("env", F.lit("test"))), "conformed")
    writers.upsert(spark, rows, f"{root}/conformed", CONFORMED_CLAIMS)
    run_load(spark, f"{root}/conformed", f"{root}/fact", LOADED_RUN)
    again = rows.where(F.col("run_date") == LOADED_RUN).withColumn("run_date", F.lit(RUN_DATE))
    writers.upsert(spark, again, f"{root}/conformed", CONFORMED_CLAIMS)
    for run_date in (LOADED_RUN, RUN_DATE):
        run_load(spark, f"{root}/conformed", f"{root}/fact", run_date)
    return readers.fact_claims(spark, f"{root}/fact")


@query
def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checks that the day itself stored."""
    return spark.read.parquet(one_day(spark, sf_dir).checks)
