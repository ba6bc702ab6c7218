"""What the large joins and writes move: fewer and shorter rows, with the same results."""

from __future__ import annotations

import glob

from pyspark.sql import functions as F

from claimforge.functions.privacy import packed, packed_text, unpacked
from claimforge.operators.median import exact_median
from claimforge.plans import models
from claimforge.sources import readers, writers
from claimforge.testtables import catalog
from claimforge.testtables import claims as src
from tests.test_catalog import SMALL as SF


def test_packed_texts_are_shorter_told_apart_and_read_back(spark):
    digest = "0a" * 32
    texts = [digest, digest.upper(), digest[:-1], digest + "\n", "M1", "", "\x01x", "Zoë", None]
    rows = spark.createDataFrame([(x,) for x in texts], "t string").withColumn("b", packed("t"))
    found = rows.select("t", "b", unpacked("b").alias("back")).collect()
    assert all(row.t == row.back for row in found)
    assert [None if row.b is None else bytes(row.b) for row in found] == [packed_text(x) for x in texts]
    assert len({bytes(row.b) for row in found if row.b is not None}) == len(texts) - 1
    assert len(found[0].b) == 33


def plan_lines(df, what):
    """Lines of a plan without adaptive steps; what a reused exchange holds is not printed again."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = df.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    return [line for line in plan.splitlines() if what in line]


def test_median_counts_its_rows_at_most_twice(spark, tmp_path):
    rows = spark.range(40).select((F.col("id") % 3).alias("k"), F.col("id").cast("decimal(18,2)").alias("v"))
    rows.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t")).select(F.struct("k").alias("g"), "v")
    found = exact_median(stored, "g", "v")
    assert 1 <= len(plan_lines(found, "FileScan")) <= 2
    expected = {k: float(sorted(range(k, 40, 3))[len(range(k, 40, 3)) // 2]) for k in (1, 2)}
    assert {row.g.k: row["median"] for row in found.collect() if row.g.k} == expected


def test_customers_join_the_orders_not_the_line_items(spark, monkeypatch):
    monkeypatch.setattr(src, "_hot", lambda *place: [])
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        wide = [line for line in plan_lines(src.claims(spark, SF), " Exchange ") if "o_custkey" in line and "l_" in line]
        plan = src.claims(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert not wide
    joins = [line for line in plan.splitlines() if "Join LeftOuter" in line]
    # The line items' join is above, that of the customers inside its right side.
    assert len(joins) == 2 and "l_orderkey" not in joins[1]


def test_landed_files_are_compressed_and_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(catalog, "LANDED_ROWS", 1000)
    rows = src.raw_claims(spark, SF).limit(2500)
    path = catalog.landed(spark, SF, str(tmp_path), rows=rows.coalesce(1))
    assert len(glob.glob(f"{path}/*.csv.gz")) == 3
    assert readers.raw_claims(spark, path).count() == 2500


def test_large_slice_is_written_by_its_scan_tasks(spark, tmp_path, monkeypatch):
    rows = spark.range(1000).select(F.col("id").alias("n"), F.lit("d").alias("day")).repartition(2)
    rows.write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    called = []
    plain = writers.compacted
    monkeypatch.setattr(writers, "compacted", lambda df, *columns: called.append(1) or plain(df, *columns))
    writers.load_slice(rows, str(tmp_path / "small"), "day", "d")
    assert called == [1]
    monkeypatch.setattr(writers, "FILE_ROWS", 10)
    writers.load_slice(rows, str(tmp_path / "large"), "day", "d")
    assert called == [1]
    for name in ("small", "large"):
        assert spark.read.parquet(str(tmp_path / name / "version=1")).count() == 1000


def test_merge_orders_claims_only_where_one_is_sent_twice(spark, tmp_path, monkeypatch):
    fact = catalog.spelled(catalog.all_facts(spark, SF))
    dims = catalog.cleaning.mask_members(src.dim_members(spark, SF)), src.dim_providers(spark, SF)
    called = []
    plain = models.latest_per_key
    monkeypatch.setattr(models, "latest_per_key", lambda *a, **k: called.append(1) or plain(*a, **k))
    once = fact.dropDuplicates(["claim_id"])
    models.merge_enriched(spark, once, *dims, str(tmp_path / "once"), catalog.NOW)
    assert not called
    models.merge_enriched(spark, once.unionByName(once), *dims, str(tmp_path / "twice"), catalog.NOW)
    assert called


def test_median_of_a_plain_group_keeps_the_group_null(spark):
    rows = spark.createDataFrame([(None, 1), (None, 3), ("a", 5)], "g string, v int")
    rows = rows.withColumn("v", F.col("v").cast("decimal(18,2)"))
    assert {row.g: row["median"] for row in exact_median(rows, "g", "v").collect()} == {None: 2.0, "a": 5.0}
