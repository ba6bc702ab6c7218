"""The order tables seen as claims (rules and fixed values as in FIXTURES.md)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimforge.operators.cleaning import mask_members
from claimforge.operators.lookup import hot_keys, lookup
from claimforge.schemas import RAW_CLAIMS

BAD_DATE = "2024-13-01"


_schemas: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The schema is read from the file once; a query may scan a table several times."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def _quantity_is(n: int) -> Column:
    return F.col("l_quantity") == n


def _price() -> Column:
    return F.col("l_extendedprice").cast("decimal(18,2)")


def _after_discount() -> Column:
    return _price() * (1 - F.col("l_discount").cast("decimal(4,2)"))


def _paid() -> Column:
    taxed = _after_discount() * (1 - F.col("l_tax").cast("decimal(4,2)"))
    return (
        F.when(_quantity_is(5), None)
        .when(F.col("l_returnflag") == "R", 0)
        .otherwise(F.round(taxed, 2))
        .cast("decimal(18,2)")
    )


def _billed() -> Column:
    return (
        F.when(_quantity_is(1), -_price())
        .when(_quantity_is(4), 0)
        .otherwise(_price())
        .cast("decimal(18,2)")
    )


def _status() -> Column:
    flags = F.concat("l_returnflag", "l_linestatus")
    return (
        F.when(flags == "RF", "DENIED")
        .when(flags == "RO", "VOID")
        .when(flags == "NF", "PENDING")
        .when(flags == "AO", "ADJUSTED")
        .otherwise("APPROVED")
    )


def _claim_type() -> Column:
    first = F.substring("o_orderpriority", 1, 1)
    return (
        F.when(first == "1", "medical")
        .when(first == "2", "pharmacy")
        .when(first == "3", "dental")
        .when(first == "4", "vision")
        .when(first == "5", "behavioral")
    )


def _shipped() -> Column:
    return F.col("l_shipdate").cast("date")


def _discharged() -> Column:
    return F.when(F.col("l_returnflag") == "R", F.date_add(_shipped(), F.col("l_linenumber")))


COLUMNS: dict[str, Callable[[], Column]] = {
    "claim_id": lambda: F.concat(
        F.lit("C"), F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber")
    ),
    "member_id": lambda: F.when(
        ~_quantity_is(2), F.concat(F.lit("M"), F.col("o_custkey").cast("string"))
    ),
    "provider_npi": lambda: F.concat(F.lit("NPI"), F.col("l_suppkey").cast("string")),
    "service_date": _shipped,
    "discharge_date": _discharged,
    "diagnosis_code": lambda: F.concat(F.lit(" d"), F.col("l_partkey") % 100, F.lit(" ")),
    "procedure_code": lambda: F.concat(F.lit("p"), F.col("l_partkey") % 50),
    "billed_amount": _billed,
    "allowed_amount": lambda: F.round(_after_discount(), 2).cast("decimal(18,2)"),
    "paid_amount": _paid,
    "claim_status": _status,
    "plan_id": lambda: F.col("c_mktsegment"),
    "claim_type": _claim_type,
    "ingested_at": lambda: F.col("l_shipdate").cast("timestamp"),
    "run_date": lambda: _shipped().cast("string"),
    "quantity": lambda: F.col("l_quantity"),
    # The dates as a raw file holds them, some of them no date at all.
    "service_text": lambda: F.when(_quantity_is(3), BAD_DATE).otherwise(
        _shipped().cast("string")
    ),
    "discharge_text": lambda: _discharged().cast("string"),
    # Tie-breakers of the latest record.
    "tie_price": lambda: F.col("l_extendedprice"),
    "tie_part": lambda: F.col("l_partkey"),
}
TIES = ["tie_price", "tie_part"]
SPREAD_BY = ("l_partkey", "l_linenumber", "l_shipdate")
NEED_ORDERS = {"member_id", "claim_type", "plan_id"}
RAW = RAW_CLAIMS.names
BATCH = [*RAW, "ingested_at", "run_date"]


def claims(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Only the tables behind the asked columns are joined, outer, so no row is lost."""
    names = columns or BATCH
    rows = table(spark, sf_dir, "lineitem")
    if NEED_ORDERS.intersection(names):
        rows = rows.withColumn("o_orderkey", F.col("l_orderkey"))
        orders = _orders(spark, sf_dir, "plan_id" in names)
        rows = lookup(rows, orders, "o_orderkey", _hot(spark, sf_dir, "lineitem", "l_orderkey"), SPREAD_BY)
    return rows.select(*[COLUMNS[name]().alias(name) for name in names])


def _orders(spark: SparkSession, sf_dir: str, segment: bool) -> DataFrame:
    """Orders as the line items look them up.

    The customer's segment is added here, to the narrow orders, so that the line items
    are moved once.
    """
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    if not segment:
        return orders
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return lookup(orders, customers, "o_custkey", _hot(spark, sf_dir, "orders", "o_custkey"), ("o_orderkey",))


_found: dict[tuple[str, str, str, str], list] = {}


def _hot(spark: SparkSession, sf_dir: str, name: str, key: str) -> list:
    """Heavy values of a table's column, found once per session by a scan of that column.

    A stale answer would only route rows less evenly.
    """
    place = (spark.sparkContext.applicationId, sf_dir, name, key)
    if place not in _found:
        _found[place] = hot_keys(table(spark, sf_dir, name), key)[key]
    return _found[place]


def heavy_claim_keys(spark: SparkSession, sf_dir: str) -> dict[str, list]:
    """The same for members (clear ids) and for providers.

    Only the members need a join, of two columns of the line items.
    """
    found = {}
    for name in ("member_id", "provider_npi"):
        place = (spark.sparkContext.applicationId, sf_dir, "claims", name)
        if place not in _found:
            _found[place] = hot_keys(claims(spark, sf_dir, name), name)[name]
        found[name] = _found[place]
    return found


def hot_claim_keys(spark: SparkSession, sf_dir: str) -> dict[str, list]:
    """``heavy_claim_keys`` with the few members masked."""
    found = heavy_claim_keys(spark, sf_dir)
    if not found["member_id"]:
        return found
    few = mask_members(spark.createDataFrame([(key,) for key in found["member_id"]], "member_id string"))
    return found | {"member_id": [row.member_id for row in few.collect()]}


def raw_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 13 raw columns with dates as text."""
    texts = {"service_date": "service_text", "discharge_date": "discharge_text"}
    rows = claims(spark, sf_dir, *[texts.get(name, name) for name in RAW])
    return rows.withColumnsRenamed({text: name for name, text in texts.items()})


def _pick(number: Column, *labels: str) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in labels]), (number + 1).cast("int"))


def _customers(spark: SparkSession, sf_dir: str, whole: bool) -> DataFrame:
    """One member in ten has no dimension row in the joins; ``whole`` is the full table."""
    known = table(spark, sf_dir, "customer")
    if not whole:
        known = known.where(F.col("c_custkey") % 10 != 0)
    return known.withColumn("member_id", F.concat(F.lit("M"), F.col("c_custkey").cast("string")))


def members(spark: SparkSession, sf_dir: str, whole: bool = False) -> DataFrame:
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    joined = _customers(spark, sf_dir, whole).join(
        nations, F.col("c_nationkey") == F.col("n_nationkey"), "left"
    )
    return joined.select(
        "member_id",
        F.col("c_mktsegment").alias("plan_type"),
        F.col("c_nationkey").cast("string").alias("group_id"),
        F.col("n_name").alias("state"),
    )


def dim_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return _customers(spark, sf_dir, False).select(
        "member_id",
        _pick(key % 5, "0-17", "18-34", "35-49", "50-64", "65+").alias("age_band"),
        _pick(key % 2, "F", "M").alias("gender"),
        (key % 4 == 0).alias("chronic_condition_flag"),
        (F.col("c_acctbal").cast("decimal(18,2)") / 100).cast("decimal(18,6)").alias("risk_score"),
    )


def _suppliers(spark: SparkSession, sf_dir: str, whole: bool) -> DataFrame:
    known = table(spark, sf_dir, "supplier")
    if not whole:
        known = known.where(F.col("s_suppkey") % 7 != 0)
    npi = F.concat(F.lit("NPI"), F.col("s_suppkey").cast("string"))
    return known.withColumn("provider_npi", npi)


def providers(spark: SparkSession, sf_dir: str, whole: bool = False) -> DataFrame:
    return _suppliers(spark, sf_dir, whole).select(
        "provider_npi",
        F.col("s_name").alias("provider_name"),
        _pick(
            F.col("s_nationkey") % 5, "cardiology", "family", "oncology", "pediatrics", "surgery"
        ).alias("specialty"),
        F.when(F.col("s_suppkey") % 3 == 0, "OUT").otherwise("IN").alias("network_flag"),
    )


def dim_providers(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    return _suppliers(spark, sf_dir, False).select(
        "provider_npi",
        _pick(key % 3, "tier1", "tier2", "tier3").alias("provider_tier"),
        (key % 2 == 0).alias("hospital_flag"),
        (key % 4 == 0).alias("teaching_hospital_flag"),
    )


def member_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Member plan changes, one row per order."""
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("M"), F.col("o_custkey").cast("string")).alias("member_id"),
        F.col("o_orderdate").cast("date").alias("change_day"),
        F.col("o_orderpriority").alias("plan_type"),
        "o_orderkey",
    )
