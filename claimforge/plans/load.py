"""Conformed claims of one run to the warehouse fact table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimforge.plans.models import usable
from claimforge.schemas import FACT_COLUMNS
from claimforge.sources import readers, versions, writers


def fact_rows(conformed: DataFrame, run_date: str | None = None) -> DataFrame:
    """The 26 fact columns, of one run or of all."""
    if run_date is not None:
        conformed = conformed.where(conformed.run_date == run_date)
    return conformed.select(*FACT_COLUMNS)


def ledger_figures() -> dict[str, Column]:
    """What the fact table's record keeps of a run: its rows, and its newest row in microseconds."""
    return {"rows": F.count(F.lit(1)), "newest": F.max(F.unix_micros("ingested_at"))}


def run_load(spark: SparkSession, conformed: str, fact: str, run_date: str) -> int:
    """Replace one run's slice of the fact table and report its rows.

    A run without rows, for instance after all of them were resubmitted, empties its
    slice. Rows and newest row are aggregates of the written slice, so a re-run task
    cannot count twice; they go into the ledger, and the slice's claims into the key
    index, in the one step that publishes the slice.
    """
    rows = fact_rows(readers.conformed_claims(spark, conformed), run_date)
    figures = ledger_figures()
    # The uniqueness check looks at usable rows only.
    return writers.load_slice(rows, fact, "run_date", run_date, figures, "claim_id", usable())["rows"]


def run_ledger(spark: SparkSession, fact: str) -> DataFrame:
    """``run_date, rows, newest`` of every loaded run, without reading a row of it."""
    kept = versions.ledger(spark, fact, rows="long", newest="long")
    run = F.substring_index("folder", "=", -1)
    return kept.select(run.alias("run_date"), "rows", F.timestamp_micros("newest").alias("newest"))
