"""Scans with declared schemas.

The claim layers and the mart are ours: their types are declared and never inferred.
Dimension files come from elsewhere: their columns are cast to the declared types.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimforge.schemas import (
    CONFORMED_CLAIMS,
    DIM_MEMBERS,
    DIM_PROVIDERS,
    FACT_CLAIMS,
    MART_CLAIMS,
    MEMBERS,
    NOTED,
    PROVIDERS,
    RAW_CLAIMS,
    REJECTED_CLAIMS,
    STAGED_CLAIMS,
)
from claimforge.sources import versions


def raw_path(root: str, run_date: str) -> str:
    """One run's folder: ``root/YYYY/MM/DD``."""
    return f"{root.rstrip('/')}/{run_date.replace('-', '/')}"


def staging_path(root: str, run_date: str) -> str:
    return f"{root.rstrip('/')}/run_date={run_date}"


def raw_claims(spark: SparkSession, path: str, fmt: str = "csv", traced: bool = False) -> DataFrame:
    """Raw claims from CSV with a header row, or from JSON lines or Parquet.

    Text that is no number becomes NULL. A CSV header in another order is an error:
    columns would be taken by position. ``traced`` adds ``line``, the text of a row that
    did not parse as declared (NULL otherwise, and for Parquet), and ``file``.
    """
    schema = RAW_CLAIMS
    if traced and fmt != "parquet":
        schema = T.StructType([*RAW_CLAIMS.fields, T.StructField("line", T.StringType())])
    reader = spark.read.schema(schema).option("columnNameOfCorruptRecord", "line")
    if fmt == "csv":
        reader = reader.option("header", True).option("enforceSchema", False)
    rows = reader.format(fmt).load(path)
    if not traced:
        return rows
    line = F.col("line") if fmt != "parquet" else F.lit(None).cast("string")
    return rows.select(*RAW_CLAIMS.names, line.alias("line"), F.col("_metadata.file_path").alias("file"))


def staged_claims(spark: SparkSession, path: str) -> DataFrame:
    """One run's staged claims; the partition column comes from the folder names."""
    return spark.read.schema(STAGED_CLAIMS).parquet(path)


def noted_claims(spark: SparkSession, path: str) -> DataFrame:
    """Staged claims that break a noting rule, for runs staged with a quarantine."""
    schema = T.StructType([*STAGED_CLAIMS.fields, *NOTED.fields])
    return spark.read.schema(schema).parquet(path).where(F.size("noted") > 0)


def rejected_claims(spark: SparkSession, path: str) -> DataFrame:
    """Raw rows that a run rejected: as parsed, with their rules, line, file and run."""
    return spark.read.schema(REJECTED_CLAIMS).parquet(path)


def conformed_claims(spark: SparkSession, path: str) -> DataFrame:
    return versions.read(spark, path, CONFORMED_CLAIMS)


def fact_claims(spark: SparkSession, path: str) -> DataFrame:
    return versions.read(spark, path, FACT_CLAIMS)


def mart_claims(spark: SparkSession, path: str) -> DataFrame:
    return versions.read(spark, path, MART_CLAIMS)


def _columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])


def members(spark: SparkSession, path: str) -> DataFrame:
    return _columns(spark.read.parquet(path), MEMBERS)


def providers(spark: SparkSession, path: str) -> DataFrame:
    return _columns(spark.read.parquet(path), PROVIDERS)


def dim_members(spark: SparkSession, path: str) -> DataFrame:
    return _columns(spark.read.parquet(path), DIM_MEMBERS)


def dim_providers(spark: SparkSession, path: str) -> DataFrame:
    return _columns(spark.read.parquet(path), DIM_PROVIDERS)
