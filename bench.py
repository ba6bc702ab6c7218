"""The daily jobs and the headline queries, timed end to end; prints one JSON line."""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable

from pyspark.sql import functions as F

from claimforge.operators.cleaning import mask_members
from claimforge.plans.extract import run_extract
from claimforge.plans.load import run_load
from claimforge.plans.models import run_models
from claimforge.plans.transform import run_transform
from claimforge.session import build_session, scratch_dir
from claimforge.sources import readers
from claimforge.testtables import catalog
from claimforge.testtables import claims as src

HEADLINE = [
    "stg_claims",
    "enrich_reference",
    "dedup_latest",
    "upsert_merge",
    "int_claims_enriched",
    "mart_claims_summary",
    "agg_distinct_counts",
    "agg_median",
    "dq_unique",
    "dq_accepted_values",
    "dq_row_count_trend",
    "scd2_build",
    "scd2_apply",
    "point_in_time_join",
]
DESIGN = {"extract": 1111, "transform": 741, "load": 1667}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "16g"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}

    def timed(name: str, job: Callable[[], object]) -> None:
        start = time.perf_counter()
        job()
        seconds[name] = round(time.perf_counter() - start, 3)

    # Landing the raw files is not part of a job; it also warms the session up.
    root = scratch_dir(spark, "bench")
    catalog.landed(spark, sf_dir, f"{root}/raw")
    claims = src.table(spark, sf_dir, "lineitem").count()
    members = mask_members(src.members(spark, sf_dir))
    providers = src.providers(spark, sf_dir)
    paths = [f"{root}/{name}" for name in ("raw", "staging", "conformed", "fact", "int", "mart")]
    raw, staging, conformed, fact, enriched, mart = paths
    run = catalog.RUN_DATE

    def transform(date: str = run) -> None:
        run_transform(spark, staging, conformed, date, members, providers, "run_date")

    def models(date: str = run) -> None:
        run_models(
            spark,
            readers.fact_claims(spark, fact),
            mask_members(src.dim_members(spark, sf_dir)),
            src.dim_providers(spark, sf_dir),
            enriched,
            mart,
            catalog.NOW,
            run_date=date,
        )

    timed("extract", lambda: run_extract(spark, raw, staging, run, "bench", catalog.NOW))
    timed("transform", transform)
    timed("transform_replay", transform)
    timed("load", lambda: run_load(spark, conformed, fact, run))
    timed("models", models)
    # A later run of one claim in a hundred, into the tables that are filled now.
    late = catalog.LATE_RUN
    few = src.raw_claims(spark, sf_dir).where(F.pmod(F.xxhash64("claim_id"), F.lit(100)) == 0)
    catalog.landed(spark, sf_dir, f"{root}/raw", rows=few, run_date=late)
    run_extract(spark, raw, staging, late, "bench", catalog.NOW)
    timed("small_transform", lambda: transform(late))
    timed("small_load", lambda: run_load(spark, conformed, fact, late))
    timed("small_models", lambda: models(late))
    for name in HEADLINE:
        query = catalog.CATALOG[name]
        timed(name, lambda q=query: q(spark, sf_dir).write.format("noop").mode("overwrite").save())

    print(
        json.dumps(
            {
                "metric": "jobs_and_headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "claims": claims,
                "claims_per_sec": {name: round(claims / seconds[name]) for name in DESIGN},
                "design_claims_per_sec": DESIGN,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
