"""Upserts and marts that are written in passes give the rows of one pass."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from claimforge.operators import merge
from claimforge.plans import measures, models
from claimforge.session import RELEASE
from claimforge.sources import key_index, versions, writers
from claimforge.testtables import catalog
from tests.test_moved_bytes import SF

ROW = "claim_id string, member_id string, amount long, run_date string, service_year int, service_month int"


def claims(spark, ids, month, amount, run_date):
    rows = [(f"C{i}", f"M{i % 7}" if i % 5 else None, amount + i, run_date, 2000 + i % 2, month(i)) for i in ids]
    return spark.createDataFrame(rows, ROW)


def batches(spark):
    """First rows, rows that move to other months or are older than what is there, and a null month."""
    first = claims(spark, range(40), lambda i: 1 + i % 6, 100, "2024-01-02")
    second = claims(spark, range(20, 30), lambda i: 1 + (i + 3) % 8, 500, "2024-01-03")
    second = second.unionByName(claims(spark, range(30, 60), lambda i: None if i % 9 == 0 else 1 + i % 12, 900, "2024-01-01"))
    return first, second


def written(spark, path, passes):
    for batch in batches(spark):
        writers.upsert(
            spark, batch, path, batch.schema, only_if_newer="run_date", change_columns=["claim_id", "amount"],
            figures={"rows": F.count(F.lit(1))}, passes=passes,
        )
    record, schema = versions.current(spark, path), batch.schema
    keys = versions.read(spark, path, schema).select(F.col("claim_id").alias("key"))
    return (
        sorted(map(repr, versions.read(spark, path, schema).collect())),
        sorted(map(repr, key_index.located(keys, path, record).collect())),
        sorted(map(repr, versions.changed_rows(spark, path, batch.select("claim_id", "amount").schema, record, 0).collect())),
        record.figures,
    )


def test_an_upsert_in_passes_gives_the_same_table_index_and_changes(spark, tmp_path, monkeypatch):
    whole = written(spark, str(tmp_path / "whole"), 1)
    monkeypatch.setattr(versions, "PASS_ROWS", 9)
    gone, plain = [], writers.merge_by_key
    monkeypatch.setattr(writers, "merge_by_key", lambda *rows, **more: gone.append(more.get("gone")) or plain(*rows, **more))
    parts = written(spark, str(tmp_path / "parts"), 3)
    assert parts == whole
    assert len(gone) > 3 and all(keys is not None for keys in gone)
    assert len(whole[0]) == 60 and any("M1" in row for row in whole[0])


def test_a_refused_source_of_passes_leaves_nothing(spark, tmp_path):
    rows = claims(spark, [1, 2, 2, 3], lambda i: i, 1, "2024-01-01")
    with pytest.raises(ValueError):
        writers.upsert(spark, rows, str(tmp_path / "t"), rows.schema, passes=2)
    assert not [path.name for path in tmp_path.rglob("*.parquet")]


def test_an_upsert_releases_its_shuffles(spark, tmp_path, monkeypatch):
    seen, plain = [], versions.write
    monkeypatch.setattr(versions, "write", lambda df, *rest: seen.append(spark.conf.get(RELEASE)) or plain(df, *rest))
    kept, rows = spark.conf.get(RELEASE), claims(spark, range(3), lambda i: 1, 1, "2024-01-01")
    writers.upsert(spark, rows, str(tmp_path / "t"), rows.schema)
    assert seen == ["true"] and spark.conf.get(RELEASE) == kept


def test_keys_that_go_may_be_others_than_the_source_rows(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "k string, v int")
    new = spark.createDataFrame([("d", 4), ("a", 5)], "k string, v int")
    gone = spark.createDataFrame([("a",), ("c",)], "k string")
    assert sorted(map(tuple, merge.merge_by_key(old, new, "k", gone=gone).collect())) == [("a", 5), ("b", 2), ("d", 4)]


def test_partitions_are_dealt_to_passes(monkeypatch):
    monkeypatch.setattr(versions, "PASS_ROWS", 10)
    names = [f"m={i}" for i in range(5)]
    assert versions.dealt(names, 10) == [names] and versions.dealt([], 99) == [[]]
    groups = versions.dealt(names, 29)
    assert len(groups) == 3 and sorted(sum(groups, [])) == names
    assert len(versions.dealt(names, 10**9)) == 5 and versions.passes_for(10**9) == versions.MOST_PASSES


def test_a_mart_of_passes_equals_that_of_one(spark, tmp_path, monkeypatch):
    base = catalog.mart_base(spark, SF, True).withColumn("run_date", F.lit("2024-01-01"))
    base = base.withColumn("member_id", F.lower(F.hex("member_id")))
    writers.upsert(spark, base, str(tmp_path / "int"), base.schema, figures={"rows": F.count(F.lit(1))})
    found = []
    for rows in (versions.PASS_ROWS, 500):
        monkeypatch.setattr(versions, "PASS_ROWS", rows)
        models.refresh_mart(spark, str(tmp_path / "int"), str(tmp_path / f"mart{rows}"), base.schema, catalog.NOW)
        mart = spark.read.parquet(*map(str, (tmp_path / f"mart{rows}").glob("version=*")))
        found.append(sorted(map(repr, mart.collect())))
    assert found[0] == found[1] and len(found[0]) > 50


def test_changed_counts_are_aggregated_once(spark, tmp_path, monkeypatch):
    kinds = "service_year int, service_month int, plan_id string, claim_type string, claim_category string, state string, "
    kinds += "claim_id string, paid_amount decimal(18,2), run_date string"

    def rows(ids, amount):
        found = [(2000, 1 + i % 3, "p", "t", "c", None if i % 2 else "s", f"C{i}", Decimal(amount + i), "2024-01-01") for i in ids]
        return spark.createDataFrame(found, kinds)

    paths = [str(tmp_path / name) for name in ("int", "cents", "medians")]
    calls, plain = [], measures.cent_counts
    scans = tmp_path / "cents__changed"
    monkeypatch.setattr(measures, "_refresh_located", lambda *given, f=measures._refresh_located: calls.append((scans.exists(), given[-1].inputFiles())) or f(*given))
    for batch in (rows(range(12), 10), rows(range(5, 20), 70)):
        writers.upsert(spark, batch, paths[0], batch.schema, change_columns=measures.FOLLOWED)
        measures.refresh_medians(spark, paths[0], batch.schema, *paths[1:])
    assert len(calls) == 1 and calls[0][0] and all("cents__changed" in name for name in calls[0][1])
    assert not scans.exists()
    stored = versions.read(spark, paths[0], batch.schema)
    whole = measures._medians(plain(stored, catalog.MART_KEYS, "paid_amount")).collect()
    found = versions.read(spark, paths[2], measures.median_schema(batch.schema)).collect()
    key = lambda row: repr([row[name] for name in (*catalog.MART_KEYS, "median")])
    assert sorted(map(key, found)) == sorted(map(key, whole)) and len(found) == 6
