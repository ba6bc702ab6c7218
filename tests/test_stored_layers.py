from __future__ import annotations

import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from claimforge.functions.privacy import register_mask
from claimforge.operators.cleaning import mask_members
from claimforge.plans.daily import (
    SEVERITY,
    CheckFailed,
    Layout,
    check_day,
    check_freshness,
    check_run,
    gate_freshness,
    gate_load,
    load_trend,
    repeated_claims,
    run_day,
)
from claimforge.operators import quality
from claimforge.plans import models
from claimforge.plans.extract import run_extract
from claimforge.plans.load import run_ledger, run_load
from claimforge.plans.models import publish_views, run_models
from claimforge.plans.transform import conform
from claimforge.schemas import CONFORMED_CLAIMS, FACT_COLUMNS, MART_CLAIMS, RAW_CLAIMS
from claimforge.session import scratch_dir
from claimforge.sources import files, key_index, readers, versions, writers

HEADER = ",".join(RAW_CLAIMS.names)


def land(root, run_date, *lines):
    folder = readers.raw_path(str(root), run_date)
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/claims.csv", "w") as out:
        out.write("\n".join([HEADER, *lines]) + "\n")


def claim(claim_id, member="M1", npi="N1", day="2024-01-10", billed="100", paid="80", status="APPROVED", kind="medical"):
    return f"{claim_id},{member},{npi},{day},,a1,p1,{billed},90,{paid},{status},PLAN,{kind}"


def test_paths():
    assert readers.raw_path("root/", "2024-06-01") == "root/2024/06/01"
    assert readers.staging_path("root", "2024-06-01") == "root/run_date=2024-06-01"


def test_csv_scan(spark, tmp_path):
    land(tmp_path, "2024-06-01", claim("c1", billed="12x"), claim("", member=""), claim("c2", day="soon"))
    found = readers.raw_claims(spark, readers.raw_path(str(tmp_path), "2024-06-01")).collect()
    assert [row.claim_id for row in found] == ["c1", None, "c2"]
    assert found[0].billed_amount is None and found[0].paid_amount == 80.0
    assert found[1].member_id is None and found[2].service_date == "soon"


@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_other_raw_formats(spark, tmp_path, fmt):
    land(tmp_path, "2024-06-01", claim("c1"), claim("c2", day="soon"))
    csv = readers.raw_claims(spark, readers.raw_path(str(tmp_path), "2024-06-01"))
    path = str(tmp_path / fmt)
    csv.write.format(fmt).save(path)
    assert sorted(readers.raw_claims(spark, path, fmt).collect()) == sorted(csv.collect())


def test_extract_counts_and_rerun(spark, tmp_path):
    land(
        tmp_path, "2024-06-01",
        claim("c1"), claim("c2", kind="dental"), claim("c3", member=""), claim("c4", billed="-1"), claim("c5", paid=""),
        claim("c6", kind=""),
    )
    staging = str(tmp_path / "staging")
    for _ in range(2):
        report = run_extract(spark, str(tmp_path), staging, "2024-06-01", "test")
        assert report == {"rows_in": 6, "rows_valid": 3, "rows_dropped": 3}
    path = readers.staging_path(staging, "2024-06-01")
    staged = readers.staged_claims(spark, path)
    kinds = {row.claim_id: row.claim_type for row in staged.collect()}
    assert kinds == {"c1": "medical", "c2": "dental", "c6": None}
    plan = staged.where("claim_type = 'dental'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(claim_type" in plan


def test_staging_by_month(spark, tmp_path, sample):
    path = str(tmp_path / "month")
    writers.write_staging_by_month(sample, path)
    assert sorted(files.partition_dirs(spark, path, 1)) == [f"service_month=2023-0{m}" for m in (3, 4, 5)]


# Upsert -------------------------------------------------------------------


def batch(spark, *items, run="r1"):
    df = spark.createDataFrame(
        list(items), "claim_id string, service_year int, service_month int, paid_amount double, t int"
    )
    columns = {f.name: f.dataType for f in CONFORMED_CLAIMS.fields}
    given = df.withColumns({"run_date": F.lit(run), "ingested_at": F.timestamp_seconds("t")})
    return given.select(
        *[
            (F.col(name) if name in given.columns else F.lit(None)).cast(kind).alias(name)
            for name, kind in columns.items()
        ]
    )


def held(spark, path):
    df = readers.conformed_claims(spark, path)
    return sorted(
        (r.claim_id, r.service_year, r.service_month, r.paid_amount) for r in df.collect()
    )


FIRST = [("a", 2024, 1, 1.0, 1), ("b", 2024, 1, 2.0, 1), ("c", 2024, 2, 3.0, 1), ("d", None, None, 4.0, 1)]
SECOND = [("b", 2024, 3, 20.0, 2), ("c", 2024, 3, 30.0, 2), ("e", 2024, 1, 5.0, 2)]
MERGED = [("a", 2024, 1, 1.0), ("b", 2024, 3, 20.0), ("c", 2024, 3, 30.0), ("d", None, None, 4.0), ("e", 2024, 1, 5.0)]


@pytest.fixture
def table(spark):
    path = scratch_dir(spark, "table")
    writers.upsert(spark, batch(spark, *FIRST), path, CONFORMED_CLAIMS)
    return path


def test_upsert_moves_rows_between_partitions(spark, table):
    for _ in range(2):
        writers.upsert(spark, batch(spark, *SECOND, run="r2"), table, CONFORMED_CLAIMS)
        assert held(spark, table) == MERGED
    # The February folder lost its only row.
    assert "service_year=2024/service_month=2" not in versions.current(spark, table).parts
    assert not files.exists(spark, f"{table}__pending")


def test_untouched_partitions_are_not_rewritten(spark, table):
    null_folder = f"{table}/version=1/service_year=__HIVE_DEFAULT_PARTITION__"
    before = {name: os.path.getmtime(f"{root}/{name}") for root, _, names in os.walk(null_folder) for name in names}
    writers.upsert(spark, batch(spark, *SECOND), table, CONFORMED_CLAIMS)
    after = {name: os.path.getmtime(f"{root}/{name}") for root, _, names in os.walk(null_folder) for name in names}
    assert before == after and before


def test_null_partition_is_merged(spark, table):
    writers.upsert(spark, batch(spark, ("d", 2025, 1, 40.0, 2)), table, CONFORMED_CLAIMS)
    assert ("d", 2025, 1, 40.0) in held(spark, table) and len(held(spark, table)) == 4


def test_older_rows_stay_out(spark, table):
    older = batch(spark, ("a", 2024, 1, 9.0, 0), ("f", 2024, 1, 6.0, 0))
    writers.upsert(spark, older, table, CONFORMED_CLAIMS, only_if_newer="ingested_at")
    assert ("a", 2024, 1, 1.0) in held(spark, table) and ("f", 2024, 1, 6.0) in held(spark, table)
    writers.upsert(spark, older, table, CONFORMED_CLAIMS)
    assert ("a", 2024, 1, 9.0) in held(spark, table)


def test_repeated_source_key_is_refused(spark, table):
    with pytest.raises(ValueError, match="upsert source is not unique"):
        writers.upsert(spark, batch(spark, SECOND[0], SECOND[0]), table, CONFORMED_CLAIMS)
    assert len(held(spark, table)) == 4


def test_a_refused_first_write_leaves_nothing(spark):
    path = scratch_dir(spark, "refused")
    with pytest.raises(ValueError, match="upsert source is not unique"):
        writers.upsert(spark, batch(spark, SECOND[0], SECOND[0]), path, CONFORMED_CLAIMS)
    assert not files.exists(spark, path) and not files.exists(spark, f"{path}__pending")


def test_an_empty_first_batch_makes_an_empty_table(spark):
    path = scratch_dir(spark, "empty")
    assert writers.upsert(spark, batch(spark, *FIRST).where("false"), path, CONFORMED_CLAIMS) == []
    assert held(spark, path) == []
    assert writers.upsert(spark, batch(spark, *FIRST), path, CONFORMED_CLAIMS) == sorted(
        ["service_year=2024/service_month=1", "service_year=2024/service_month=2",
         "service_year=__HIVE_DEFAULT_PARTITION__/service_month=__HIVE_DEFAULT_PARTITION__"]
    )
    assert len(held(spark, path)) == 4


def test_an_upsert_casts_to_the_layer(spark, table):
    other = batch(spark, *SECOND).withColumns(
        {"paid_amount": F.col("paid_amount").cast("decimal(12,3)"), "service_month": F.col("service_month").cast("long")}
    )
    writers.upsert(spark, other, table, CONFORMED_CLAIMS)
    assert held(spark, table) == MERGED
    assert spark.read.parquet(table).schema["paid_amount"].dataType == CONFORMED_CLAIMS["paid_amount"].dataType


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_an_upsert_with_and_without_broadcast(spark, table, threshold):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        writers.upsert(spark, batch(spark, *SECOND), table, CONFORMED_CLAIMS)
        assert held(spark, table) == MERGED
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_empty_source_changes_nothing(spark, table):
    before = held(spark, table)
    writers.upsert(spark, batch(spark, *SECOND).where("false"), table, CONFORMED_CLAIMS)
    assert held(spark, table) == before


class Lost(Exception):
    pass


@pytest.mark.parametrize("step", ["write", "appended", "publish"])
def test_an_interrupted_upsert_leaves_the_table_and_is_repeated(spark, table, monkeypatch, step):
    before = held(spark, table)
    place = {"write": versions, "appended": key_index, "publish": versions}[step]
    work = getattr(place, step)

    def breaking(*args):
        if step == "write":
            work(*args)
        raise Lost

    monkeypatch.setattr(place, step, breaking)
    with pytest.raises(Lost):
        writers.upsert(spark, batch(spark, *SECOND), table, CONFORMED_CLAIMS)
    monkeypatch.undo()
    assert held(spark, table) == before
    writers.upsert(spark, batch(spark, *SECOND), table, CONFORMED_CLAIMS)
    assert held(spark, table) == MERGED


def test_an_interrupted_first_upsert_is_repeated(spark, monkeypatch):
    path = scratch_dir(spark, "first")
    monkeypatch.setattr(versions, "publish", lambda *args: (_ for _ in ()).throw(Lost()))
    with pytest.raises(Lost):
        writers.upsert(spark, batch(spark, *FIRST, *SECOND[2:]), path, CONFORMED_CLAIMS)
    monkeypatch.undo()
    writers.upsert(spark, batch(spark, *FIRST), path, CONFORMED_CLAIMS)
    assert len(held(spark, path)) == 4


def test_a_reader_sees_old_or_new_rows_at_every_step(spark, table, monkeypatch):
    before = held(spark, table)
    begun = readers.conformed_claims(spark, table)
    seen = []
    for place, name in ((files, "partition_dirs"), (files, "write_text"), (files, "remove")):
        work = getattr(place, name)
        monkeypatch.setattr(place, name, lambda *args, work=work: (seen.append(held(spark, table)), work(*args), seen.append(held(spark, table)))[1])
    writers.upsert(spark, batch(spark, *SECOND), table, CONFORMED_CLAIMS)
    monkeypatch.undo()
    assert len(seen) >= 6 and seen[0] == before and seen[-1] == MERGED
    switch = seen.index(MERGED)
    assert set(map(str, seen[:switch])) == {str(before)} and set(map(str, seen[switch:])) == {str(MERGED)}
    # A reader that began before the switch ends with the rows it began with.
    assert begun.count() == 4


def test_old_versions_go(spark, table):
    for i in range(versions.KEPT + 2):
        writers.upsert(spark, batch(spark, ("a", 2024, 1, float(i), 1)), table, CONFORMED_CLAIMS)
    assert ("a", 2024, 1, float(versions.KEPT + 1)) in held(spark, table) and len(held(spark, table)) == 4
    folders = [n for n in files.partition_dirs(spark, table, 3) if n.endswith("service_year=2024/service_month=1")]
    assert len(folders) == versions.KEPT
    assert len(files.names(spark, f"{table}/_published")) == versions.KEPT


def test_a_lost_record_name_is_not_written_twice(spark, table):
    with pytest.raises(OSError, match="somebody else"):
        versions.publish(spark, table, versions.current(spark, table))


def test_files_of_others_are_refused(spark, tmp_path):
    path = str(tmp_path / "plain")
    batch(spark, *FIRST).write.parquet(path)
    assert readers.conformed_claims(spark, path).count() == 4
    with pytest.raises(ValueError, match="no upsert wrote"):
        writers.upsert(spark, batch(spark, *FIRST), path, CONFORMED_CLAIMS)


# Key index ----------------------------------------------------------------


def many(spark, low, high, month):
    items = [(f"k{i}", 2024, month, float(i), 1) for i in range(low, high)]
    return batch(spark, *items)


def paths_read(df):
    return {name.split("?")[0] for name in df.inputFiles()}


def test_a_lookup_reads_only_the_buckets_of_its_keys(spark):
    path = scratch_dir(spark, "index")
    writers.upsert(spark, many(spark, 0, 400, 1), path, CONFORMED_CLAIMS)
    record = versions.current(spark, path)
    keys = spark.createDataFrame([("k7",), ("k8",), ("none",)], "key string")
    found = key_index.located(keys, path, record)
    assert {r.key: r.folder for r in found.collect()} == dict.fromkeys(["k7", "k8"], "service_year=2024/service_month=1")
    buckets = {r.b for r in keys.select(key_index.bucket_of(F.col("key"), record.buckets).alias("b")).collect()}
    read = {name for name in paths_read(found) if path in name}
    assert read and {name.split("bucket=")[1].split("/")[0] for name in read} <= set(map(str, buckets))
    assert len(buckets) < record.buckets


def test_an_upsert_reads_no_other_partition_of_the_table(spark, monkeypatch):
    path = scratch_dir(spark, "index")
    for month in (1, 2, 3):
        writers.upsert(spark, many(spark, 100 * month, 100 * month + 50, month), path, CONFORMED_CLAIMS)
    asked = []
    read = versions.read
    monkeypatch.setattr(versions, "read", lambda *args: (asked.append(args[4]), read(*args))[1])
    writers.upsert(spark, batch(spark, ("k110", 2024, 5, 1.0, 2)), path, CONFORMED_CLAIMS)
    monkeypatch.undo()
    assert asked == [{"service_year=2024/service_month=1", "service_year=2024/service_month=5"}]
    assert ("k110", 2024, 5, 1.0) in held(spark, path) and len(held(spark, path)) == 150


def test_index_after_moves_compaction_and_rebuild(spark, monkeypatch):
    path = scratch_dir(spark, "index")
    monkeypatch.setattr(key_index, "MOST_ENTRIES", 2)
    place = {}
    for turn in range(6):
        items = [(f"k{i}", 2024, 1 + (i + turn) % 5, 1.0, 1) for i in range(turn * 7, turn * 7 + 30)]
        place |= {name: f"service_year=2024/service_month={month}" for name, _, month, *_ in items}
        writers.upsert(spark, batch(spark, *items), path, CONFORMED_CLAIMS)
    keys = spark.createDataFrame([(name,) for name in place], "key string")

    def index():
        record = versions.current(spark, path)
        return {r.key: r.folder for r in key_index.located(keys, path, record).collect()}, record

    found, record = index()
    assert found == place and max(map(len, record.index.values())) <= 2
    assert {name: f"service_year={y}/service_month={m}" for name, y, m, _ in held(spark, path)} == place
    key_index.rebuild(spark, path, CONFORMED_CLAIMS, "claim_id", ["service_year", "service_month"], 4)
    found, record = index()
    assert found == place and (record.buckets, set(record.index)) == (4, {f"bucket={i}" for i in range(4)})
    writers.upsert(spark, batch(spark, ("k3", 2024, 9, 1.0, 1)), path, CONFORMED_CLAIMS)
    assert index()[0]["k3"] == "service_year=2024/service_month=9"


def test_number_of_buckets():
    assert [key_index.buckets_for(n) for n in (0, 10**6, 10**8, 10**12)] == [16, 16, 128, 4096]


def test_load_replaces_its_slice(spark, table, tmp_path):
    fact = str(tmp_path / "fact")
    assert run_load(spark, table, fact, "r1") == 4
    assert run_load(spark, table, fact, "r1") == 4
    writers.upsert(spark, batch(spark, *SECOND, run="r2"), table, CONFORMED_CLAIMS)
    assert run_load(spark, table, fact, "r2") == 3
    loaded = readers.fact_claims(spark, fact)
    assert loaded.columns == FACT_COLUMNS and loaded.count() == 7


def test_an_emptied_slice_goes(spark, table, tmp_path):
    fact = str(tmp_path / "fact")
    assert run_load(spark, table, fact, "r1") == 4
    writers.upsert(spark, batch(spark, *FIRST, run="r2"), table, CONFORMED_CLAIMS)
    assert run_load(spark, table, fact, "r1") == 0 and run_load(spark, table, fact, "r2") == 4
    assert {r.run_date for r in readers.fact_claims(spark, fact).collect()} == {"r2"}


def test_register_and_analyze(spark, table):
    writers.register_table(
        spark, "conformed_for_test", table, CONFORMED_CLAIMS, ["service_year", "service_month"]
    )
    writers.analyze(spark, "conformed_for_test", {"service_year": "2024", "service_month": "1"})
    january = "DESCRIBE EXTENDED conformed_for_test PARTITION (service_year = 2024, service_month = 1)"
    described = {r.col_name: r.data_type for r in spark.sql(january).collect()}
    assert "2 rows" in described["Partition Statistics"]
    writers.analyze(spark, "conformed_for_test")
    assert spark.table("conformed_for_test").count() == 4
    described = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED conformed_for_test").collect()}
    assert "4 rows" in described["Statistics"]
    with pytest.raises(PySparkException):
        writers.merge_into_table(readers.conformed_claims(spark, table), "conformed_for_test")


# Whole days ---------------------------------------------------------------


@pytest.fixture
def dims(spark):
    members = spark.createDataFrame([("M1", "gold", "g1", "NY")], "member_id string, plan_type string, group_id string, state string")
    providers = spark.createDataFrame(
        [("N1", "Clinic", "family", "IN"), ("N2", "Lab", "surgery", "OUT")],
        "provider_npi string, provider_name string, specialty string, network_flag string",
    )
    dim_members = spark.createDataFrame(
        [("M1", "18-34", "F", False)], "member_id string, age_band string, gender string, chronic_condition_flag boolean"
    ).withColumn("risk_score", F.lit("1.50").cast("decimal(18,2)"))
    dim_providers = spark.createDataFrame(
        [("N1", "tier1", True, False)],
        "provider_npi string, provider_tier string, hospital_flag boolean, teaching_hospital_flag boolean",
    )
    return members, providers, dim_members, dim_providers


def test_two_days(spark, tmp_path, dims):
    layout = Layout(*[str(tmp_path / name) for name in ("raw", "staging", "conformed", "fact", "int", "mart")])
    land(
        layout.raw, "2024-02-01",
        claim("c1", paid="20000", billed="25000"), claim("c1", paid="10", billed="25000"), claim("c2", npi="N2", kind="dental"),
        claim("c3", member="M9", npi="N9", kind="Pharmacy"), claim("c4", day="2024-13-01"),
    )
    first = run_day(spark, layout, "2024-02-01", *dims, env="test", as_of="2024-02-01 05:00:00", fact_table="fact_for_test")
    assert first == {"rows_in": 5, "rows_valid": 5, "rows_dropped": 0, "rows_loaded": 4}
    mart = {(r.claim_type, r.claim_category): r for r in readers.mart_claims(spark, layout.mart).collect()}
    # The greater amount of the tied copies stays; the claim without a date is no usable row.
    assert set(mart) == {("medical", "high_cost_medical"), ("dental", "out_of_network"), ("pharmacy", "pharmacy")}
    assert mart["pharmacy", "pharmacy"].state is None and mart["medical", "high_cost_medical"].avg_member_risk_score == 1.5

    # c1 comes again, for another month and denied.
    land(layout.raw, "2024-02-02", claim("c1", day="2024-02-05", paid="0", status="DENIED"), claim("c5"))
    second = run_day(spark, layout, "2024-02-02", *dims, env="test", as_of="2024-02-02 05:00:00", fact_table="fact_for_test")
    assert second["rows_loaded"] == 2
    mart = {(r.service_month, r.claim_type, r.claim_category): r for r in readers.mart_claims(spark, layout.mart).collect()}
    assert set(mart) == {
        (1, "dental", "out_of_network"), (1, "pharmacy", "pharmacy"), (1, "medical", "standard"), (2, "medical", "standard"),
    }
    assert (mart[2, "medical", "standard"].denied_claims, mart[2, "medical", "standard"].denial_rate_pct) == (1, 100.0)
    assert sum(row.total_claims for row in mart.values()) == 4

    # Both runs of c1 are fact rows, which the uniqueness check reports.
    for checked in (check_day(spark, layout), check_run(spark, layout, "2024-02-02")):
        report = {(r.table_name, r.rule, r.column_name): r.failures for r in checked.collect()}
        assert report[("stg_claims", "unique", "claim_id")] == 1
    assert report.pop(("stg_claims", "unique", "claim_id")) == 1
    assert set(report.values()) == {0} and len(report) == 9

    assert check_freshness(spark, layout, "2024-02-03 06:00:00").first().status == "warn"
    trend = {str(r.day): (r.rows, r.avg_before, r.suspicious) for r in load_trend(spark, layout, 0.6).collect()}
    assert trend == {"2024-02-01": (4, None, None), "2024-02-02": (2, 4.0, True)}


def day_layout(tmp_path):
    return Layout(*[str(tmp_path / n) for n in ("raw", "staging", "conformed", "fact", "int", "mart", "checks")])


def mart_sums(spark, layout):
    """Month to claims and paid amount of the mart."""
    found = {}
    for r in readers.mart_claims(spark, layout.mart).collect():
        claims, paid = found.get(r.service_month, (0, 0.0))
        found[r.service_month] = (claims + r.total_claims, paid + float(r.total_paid))
    return found


def test_a_corrected_day_arrives_everywhere(spark, tmp_path, dims):
    layout = day_layout(tmp_path)
    for lines in ([claim("c1", paid="80")], [claim("c1", paid="33"), claim("c2", paid="7", day="2024-03-01")]):
        land(layout.raw, "2024-02-01", *lines)
        run_day(spark, layout, "2024-02-01", *dims, env="test", as_of="2024-02-01 05:00:00")
    assert mart_sums(spark, layout) == {1: (1, 33.0), 3: (1, 7.0)}
    fact = {r.claim_id: r.paid_amount for r in readers.fact_claims(spark, layout.fact).collect()}
    assert fact == {"c1": 33.0, "c2": 7.0}


def test_a_late_run_adds_and_replaces_nothing_newer(spark, tmp_path, dims):
    layout = day_layout(tmp_path)
    land(layout.raw, "2024-02-02", claim("c1", paid="20"))
    land(layout.raw, "2024-02-01", claim("c1", paid="10"), claim("c2", paid="5", day="2024-04-01"))
    for run_date in ("2024-02-02", "2024-02-01"):
        run_day(spark, layout, run_date, *dims, env="test", as_of="2024-02-03 05:00:00")
    assert mart_sums(spark, layout) == {1: (1, 20.0), 4: (1, 5.0)}
    assert readers.fact_claims(spark, layout.fact).count() == 2


def test_touched_months_equal_a_full_rebuild(spark, tmp_path, dims):
    layout = day_layout(tmp_path)
    runs = {
        "2024-02-01": [claim("c1"), claim("c2", day="2024-02-10", paid="1"), claim("c3", day="2024-03-10")],
        # c1 leaves January, its only claim there; March stays untouched.
        "2024-02-02": [claim("c1", day="2024-02-03", paid="2")],
    }
    for run_date, lines in runs.items():
        land(layout.raw, run_date, *lines)
        run_day(spark, layout, run_date, *dims, env="test", as_of="2024-02-03 05:00:00")
    kept = sorted(map(str, readers.mart_claims(spark, layout.mart).collect()))
    assert sorted(mart_sums(spark, layout)) == [2, 3]
    fact = readers.fact_claims(spark, layout.fact)
    dim_members, dim_providers = mask_members(dims[2]), dims[3]
    run_models(
        spark, fact, dim_members, dim_providers, layout.enriched, layout.mart, "2024-02-03 05:00:00",
        run_date="2024-02-02", rebuild_mart=True,
    )
    assert sorted(map(str, readers.mart_claims(spark, layout.mart).collect())) == kept


@pytest.mark.parametrize("lost_at", ["mart", "upsert"])
def test_an_interrupted_day_is_made_up_for(spark, tmp_path, dims, monkeypatch, lost_at):
    layout = day_layout(tmp_path)
    when = "2024-02-03 05:00:00"
    land(layout.raw, "2024-02-01", claim("c1", day="2024-03-01"), claim("c2", day="2024-03-02"), claim("c3", day="2024-04-02"))
    run_day(spark, layout, "2024-02-01", *dims, env="test", as_of=when)
    land(layout.raw, "2024-02-02", claim("c1", day="2024-05-01", paid="20"))
    publish = versions.publish

    lost_path = {"mart": layout.mart, "upsert": layout.enriched}[lost_at]

    def breaking(spark, path, record):
        # Everything is written, only the switch is missing.
        if path == lost_path:
            raise Lost
        publish(spark, path, record)

    monkeypatch.setattr(versions, "publish", breaking)
    with pytest.raises(Lost):
        run_day(spark, layout, "2024-02-02", *dims, env="test", as_of=when)
    monkeypatch.undo()
    run_day(spark, layout, "2024-02-02", *dims, env="test", as_of=when)
    assert mart_sums(spark, layout) == {3: (1, 80.0), 4: (1, 80.0), 5: (1, 20.0)}
    records = versions.current(spark, layout.enriched), versions.current(spark, layout.mart)
    assert versions.unseen(*records, layout.enriched) == ([], [])
    kept = sorted(map(str, readers.mart_claims(spark, layout.mart).collect()))
    fact = readers.fact_claims(spark, layout.fact)
    schema = models.int_schema(models.stg_claims(fact))
    models.refresh_mart(spark, layout.enriched, layout.mart, schema, when, rebuild=True)
    assert sorted(map(str, readers.mart_claims(spark, layout.mart).collect())) == kept


def test_the_ledger_equals_a_scan(spark, tmp_path, dims):
    layout = day_layout(tmp_path)
    for day, lines in (("2024-02-01", [claim("c1"), claim("c2")]), ("2024-02-02", [claim("c1", paid="1")]), ("2024-02-01", [claim("c2")])):
        land(layout.raw, day, *lines)
        run_day(spark, layout, day, *dims, env="test", as_of=f"{day} 05:00:00", severity=SEVERITY | {"freshness": "warn"})
    fact = readers.fact_claims(spark, layout.fact)
    scanned = fact.groupBy("run_date").agg(F.count(F.lit(1)).alias("rows"), F.max("ingested_at").alias("newest"))
    assert sorted(run_ledger(spark, layout.fact).collect()) == sorted(scanned.collect())
    assert not [name for name in run_ledger(spark, layout.fact).inputFiles() if "fact" in name]
    moment = "2024-02-03 06:00:00"
    assert check_freshness(spark, layout, moment).collect() == quality.freshness(fact, moment).collect()
    counted = quality.row_count_trend(quality.daily_counts(fact, "run_date"), min_share=0.6)
    assert sorted(load_trend(spark, layout, 0.6).collect()) == sorted(counted.collect())
    schema = models.int_schema(models.stg_claims(fact))
    assert models.stored_mark(spark, layout.enriched) == versions.read(spark, layout.enriched, schema).agg(F.max("run_date")).first()[0]


def test_an_old_load_stops_the_day(spark, tmp_path, dims):
    layout = day_layout(tmp_path)
    land(layout.raw, "2024-02-01", claim("c1"))
    # The clock that stamps rows is pinned; a later one judges them.
    run_day(spark, layout, "2024-02-01", *dims, env="test", as_of="2024-02-01 05:00:00")
    gate_freshness(spark, layout, "2024-02-03 04:00:00")
    with pytest.raises(CheckFailed, match="newest row"):
        gate_freshness(spark, layout, "2024-02-03 06:00:00")
    gate_freshness(spark, layout, "2024-02-03 06:00:00", {"freshness": "warn"})


def test_uniqueness_of_a_run_equals_a_scan(spark, tmp_path, dims):
    layout = day_layout(tmp_path)
    runs = [
        ("2024-02-01", ["c1", "c2", "c3"]), ("2024-02-02", ["c2", "c4"]), ("2024-02-03", ["c2", "c3", "c5"]),
        # The first run again, without c3: c3 is in one run now.
        ("2024-02-01", ["c1", "c2"]),
    ]
    for day, names in runs:
        land(layout.raw, day, *[claim(name) for name in names])
        # The conformed layer keeps one run per claim; fact slices of runs loaded before keep theirs.
        run_extract(spark, layout.raw, layout.staging, day, "test", "2024-02-03 05:00:00")
        rows = conform_for_test(spark, layout, day, dims)
        rows.write.mode("overwrite").parquet(f"{layout.conformed}-{day}")
        run_load(spark, f"{layout.conformed}-{day}", layout.fact, day)
    for day, expected in (("2024-02-01", {"c2"}), ("2024-02-02", {"c2"}), ("2024-02-03", {"c2"})):
        found = repeated_claims(spark, layout.fact, day)
        assert {r.claim_id for r in found.collect()} == expected
        slices = {name.split("run_date=")[1].split("/")[0] for name in found.inputFiles() if "run_date=" in name}
        assert slices == {day}


def conform_for_test(spark, layout, day, dims):
    staged = readers.staged_claims(spark, readers.staging_path(layout.staging, day))
    return conform(staged, mask_members(dims[0]), dims[1])


def test_failing_checks_and_low_loads_stop_the_day(spark, tmp_path, dims):
    layout = day_layout(tmp_path)
    land(layout.raw, "2024-02-01", claim("c1", kind="hospice"), claim("c2"), claim("c3"))
    with pytest.raises(CheckFailed, match="claim_type accepted_values: 1"):
        run_day(spark, layout, "2024-02-01", *dims, env="test")
    stored = {(r.rule, r.column_name): r.failures for r in spark.read.parquet(layout.checks).collect()}
    assert stored["accepted_values", "claim_type"] == 1 and len(stored) == 10
    lenient = SEVERITY | {"accepted_values": "warn"}
    land(layout.raw, "2024-02-02", claim("c4"))
    run_day(spark, layout, "2024-02-02", *dims, env="test", severity=lenient, min_share=0.3)
    land(layout.raw, "2024-02-03", claim("c5"))
    with pytest.raises(CheckFailed, match="1 rows loaded for 2024-02-03"):
        run_day(spark, layout, "2024-02-03", *dims, env="test", severity=lenient, min_share=0.6)
    with pytest.raises(CheckFailed, match="nothing loaded"):
        gate_load(spark, layout, "2024-02-09", 0.5)


def test_odd_amounts_are_dropped_and_counted(spark, tmp_path):
    lines = [claim(f"c{i}", billed=b) for i, b in enumerate(("NaN", "Infinity", "1e20", "100", "-1", "x"))]
    land(tmp_path, "2024-06-01", *lines)
    report = run_extract(spark, str(tmp_path), str(tmp_path / "staging"), "2024-06-01", "test")
    assert report == {"rows_in": 6, "rows_valid": 1, "rows_dropped": 5}


def test_a_header_in_another_order_is_an_error(spark, tmp_path):
    land(tmp_path, "2024-06-01", claim("c1"))
    path = f"{readers.raw_path(str(tmp_path), '2024-06-01')}/claims.csv"
    with open(path) as lines:
        text = lines.read().replace("claim_id,member_id", "member_id,claim_id")
    with open(path, "w") as out:
        out.write(text)
    with pytest.raises(Exception, match="does not conform to the schema"):
        readers.raw_claims(spark, readers.raw_path(str(tmp_path), "2024-06-01")).collect()


def test_layer_types(spark, tmp_path, dims):
    layout = day_layout(tmp_path)
    land(layout.raw, "2024-02-01", claim("c1"))
    members = dims[2].withColumn("risk_score", F.lit(1.0345))
    run_day(spark, layout, "2024-02-01", *dims[:2], members, dims[3], env="test")
    mart = readers.mart_claims(spark, layout.mart)
    assert mart.first().avg_member_risk_score == 1.0345
    assert {f.name: f.dataType for f in mart.schema} == {f.name: f.dataType for f in MART_CLAIMS}
    enriched = {f.name: f.dataType.simpleString() for f in spark.read.parquet(layout.enriched).schema}
    assert (enriched["risk_score"], enriched["paid_amount"], enriched["cost_ratio"]) == (
        "decimal(18,6)", "decimal(18,2)", "decimal(8,4)",
    )
    again = dims[2].unionByName(dims[2])
    with pytest.raises(ValueError, match="dim_members is not unique"):
        run_day(spark, layout, "2024-02-01", *dims[:2], again, dims[3], env="test")


def test_repeated_dimension_key_is_refused(spark, tmp_path, dims):
    layout = Layout(*[str(tmp_path / name) for name in ("raw", "staging", "conformed", "fact", "int", "mart")])
    land(layout.raw, "2024-02-01", claim("c1"))
    members = dims[0].unionByName(dims[0])
    with pytest.raises(ValueError, match="members is not unique"):
        run_day(spark, layout, "2024-02-01", members, *dims[1:])


def test_mart_layout(spark, tmp_path):
    mart = spark.range(1000).select(
        F.concat(F.lit("p"), F.col("id") % 3).alias("plan_id"),
        (2020 + F.col("id") % 5).alias("service_year"), (1 + F.col("id") % 12).alias("service_month"),
    )
    path = str(tmp_path / "mart")
    writers.write_mart(mart, path)
    by_file = {}
    for row in spark.read.parquet(path).withColumn("f", F.input_file_name()).collect():
        by_file.setdefault(row.f, []).append((row.service_year, row.service_month, row.plan_id))
    assert all(rows == sorted(rows) and len({r[:2] for r in rows}) == 1 for rows in by_file.values())
    assert sum(map(len, by_file.values())) == 1000


def test_masked_dimension_matches(spark, dims):
    members = mask_members(dims[0])
    claims = mask_members(spark.createDataFrame([("M1",)], "member_id string"))
    assert claims.join(members, "member_id").count() == 1


def test_sql_views(spark, table, dims):
    publish_views(readers.conformed_claims(spark, table).select(*FACT_COLUMNS), *dims[2:], "2024-02-01 00:00:00")
    # No member ids in this table, so the staging filter leaves nothing.
    assert spark.sql("select count(*) as n from mart_claims_summary").first().n == 0
    rows = readers.conformed_claims(spark, table).where("claim_id = 'a'").withColumns(
        {"member_id": F.lit("M1"), "billed_amount": F.lit(90.0), "service_date": F.lit("2024-01-10").cast("date")}
    )
    twice = rows.withColumn("paid_amount", F.lit(80.0)).unionByName(
        rows.withColumns({"paid_amount": F.lit(10.0), "run_date": F.lit("r2")})
    )
    publish_views(twice.select(*FACT_COLUMNS), *dims[2:], "2024-02-01 00:00:00")
    assert [float(r.total_paid) for r in spark.sql("select total_paid from mart_claims_summary").collect()] == [10.0]
    register_mask(spark)
    expected = "ca978112ca1bbdcafac231b39a23dc4da786eff8147c4e72b9807785afee48bb"
    assert spark.sql("select pii_mask('a') as m").first().m == expected
