"""Shuffles that are spared, and the results that must not change by it."""

from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from claimforge.operators import summary
from claimforge.operators.numbering import bitmaps
from claimforge.plans import measures, models
from claimforge.sources import key_index, versions, writers
from claimforge.testtables import catalog
from claimforge.testtables import claims as src
from tests.test_moved_bytes import SF, plan_lines

ROW = "service_year int, service_month int, plan_id string, claim_type string, claim_category string, state string, "
ROW += "claim_id string, member_id string, provider_npi string, paid_amount decimal(18,2)"


def shuffled(spark, monkeypatch, build):
    """The exchanges of claims in a plan that broadcasts next to nothing."""
    monkeypatch.setattr(src, "_hot", lambda *place: [])
    monkeypatch.setattr(src, "heavy_claim_keys", lambda *place: {"member_id": [None], "provider_npi": []})
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return [line for line in plan_lines(build(), " Exchange hashpartitioning(") if "provider_npi" not in line]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_members_are_masked_after_their_joins(spark, monkeypatch):
    lines = shuffled(spark, monkeypatch, lambda: catalog.stg_claims(spark, SF))
    by_member = [line for line in lines if "hashpartitioning(member_id" in line]
    assert len(by_member) == 2 and not any("_spot" in line for line in lines)
    monkeypatch.undo()
    ids = catalog.stg_claims(spark, SF).select("member_id").distinct().collect()
    clear = src.claims(spark, SF, "member_id").where("member_id is not null").select(F.sha2("member_id", 256)).distinct()
    assert {row[0] for row in ids} <= {row[0] for row in clear.collect()} and ids


def test_first_claim_of_a_member_is_marked_where_the_members_joined(spark, monkeypatch):
    keys = catalog.MART_KEYS
    marked = shuffled(spark, monkeypatch, lambda: catalog.mart_base(spark, SF, True, keys))
    plain = shuffled(spark, monkeypatch, lambda: catalog.mart_base(spark, SF, True))
    assert len(marked) == len(plain)


def test_distinct_counts_in_scans_of_their_own(spark, tmp_path):
    group = (2000, 1, None, "t", "c", None)
    rows = [
        (*group, "C1", "m", "p", 1), (*group, "C2", "m", "q", 2), (*group, "C2", None, None, 3), (*group, None, "n", "q", 4),
        (2000, 2, "x", "t", "c", "s", "C4", None, None, None), (2000, 2, "x", "t", "c", "s", "C4", "m", "p", None),
        (2000, 3, "x", "t", None, "s", "C5", None, None, 5),
    ]
    df = spark.createDataFrame([(*row[:9], None if row[9] is None else str(row[9])) for row in rows], ROW.replace("decimal(18,2)", "string"))
    df = df.withColumn("paid_amount", F.col("paid_amount").cast("decimal(18,2)"))
    summary.mark_first(df, "first").write.parquet(str(tmp_path / "base"))
    base = spark.read.parquet(str(tmp_path / "base"))
    names = ["total_claims", "unique_members", "unique_providers", "total_paid", summary.MEDIAN]
    for measures in (names, names[:1], names[1:2], names[:3]):
        for unique in (False, True):
            expected = sorted(map(str, summary.summarize(base, measures=measures, claims_unique=unique).collect()))
            for options in ({"stored": True}, {"stored": True, "member_first": "first"}, {"member_first": "first"}):
                found = summary.summarize(base, measures=measures, claims_unique=unique, **options)
                assert sorted(map(str, found.collect())) == expected


def test_a_first_write_looks_up_no_keys(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(key_index, "located", lambda *a: 1 / 0)
    batch = spark.createDataFrame([("a", 2000, 1, "r"), ("b", 2000, 2, "r")], "claim_id string, service_year int, service_month int, run_date string")
    path = str(tmp_path / "t")
    assert len(writers.upsert(spark, batch, path, batch.schema)) == 2
    monkeypatch.undo()
    again = batch.withColumn("service_month", F.lit(3))
    assert len(writers.upsert(spark, again, path, batch.schema)) == 3
    found = versions.read(spark, path, batch.schema).select("claim_id", "service_month").collect()
    assert sorted(map(tuple, found)) == [("a", 3), ("b", 3)]


def test_a_first_upsert_stores_its_batch_once(spark, tmp_path, monkeypatch):
    rows = [("C1", 2000, 1, "a"), ("C2", 2000, 2, "a"), ("C3", None, None, None)]
    rows = spark.createDataFrame(rows, "claim_id string, service_year int, service_month int, run_date string")
    stored, plain = [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path, *a, **k: stored.append(path) or plain(self, path, *a, **k))
    path = str(tmp_path / "t")
    assert len(writers.upsert(spark, rows, path, rows.schema)) == 3
    assert stored == [f"{path}/version=1", f"{path}/_index/version=1"]
    assert sorted(map(str, versions.read(spark, path, rows.schema).collect())) == sorted(map(str, rows.collect()))
    # A merge finds the rows of the first write by their keys, also one that moves.
    again = rows.where("claim_id = 'C2'").withColumn("service_month", F.lit(1))
    writers.upsert(spark, again, path, rows.schema)
    found = {row.claim_id: row.service_month for row in versions.read(spark, path, rows.schema).collect()}
    assert found == {"C1": 1, "C2": 1, "C3": None}


def test_a_merge_moves_digests_as_bytes(spark, tmp_path, monkeypatch):
    members = ["0a" * 32, "0A" * 32, "M1", "", None]
    rows = [(f"C{n}", member, 2000, 1, "a") for n, member in enumerate(members)]
    rows = spark.createDataFrame(rows, "claim_id string, member_id string, service_year int, service_month int, run_date string")
    kinds, plain = [], writers.merge_by_key
    monkeypatch.setattr(writers, "merge_by_key", lambda old, new, key: kinds.append(dict(old.dtypes)["member_id"]) or plain(old, new, key))
    path = str(tmp_path / "t")
    writers.upsert(spark, rows, path, rows.schema)
    writers.upsert(spark, rows.where("claim_id = 'C0'").withColumn("member_id", F.lit("0b" * 32)), path, rows.schema)
    assert kinds == ["binary"]
    found = {row.claim_id: row.member_id for row in versions.read(spark, path, rows.schema).collect()}
    assert found == {f"C{n}": member for n, member in enumerate(["0b" * 32, *members[1:]])}


def test_a_merge_of_claims_joins_members_as_bytes(spark, tmp_path, monkeypatch):
    kinds, plain = [], models.int_claims
    monkeypatch.setattr(models, "int_claims", lambda stg, *a: kinds.append(dict(stg.dtypes)["member_id"]) or plain(stg, *a))
    fact = catalog.spelled(catalog.all_facts(spark, SF))
    dims = catalog.cleaning.mask_members(src.dim_members(spark, SF)), src.dim_providers(spark, SF)
    schema = models.merge_enriched(spark, fact, *dims, str(tmp_path / "int"), catalog.NOW)
    assert kinds == ["binary"]
    found = versions.read(spark, str(tmp_path / "int"), schema)
    assert {len(row[0]) for row in found.select("member_id").distinct().collect()} == {64}
    assert found.where("age_band is not null").count() > 0


def test_rows_reach_their_numbers_in_one_move(spark, tmp_path, monkeypatch):
    rows = [("C1", "m", "p", 1), ("C2", "m", "p", 1), ("C3", "0a" * 32, None, 1), ("C4", None, "p", 2), ("C5", "m", "q", 2)]
    rows = spark.createDataFrame(rows, "claim_id string, member_id string, provider_npi string, service_month int")
    rows = rows.withColumns({"service_year": F.lit(2000), "plan_id": F.lit("x"), "run_date": F.lit("a")})
    plans = []
    monkeypatch.setattr(measures, "bitmaps", lambda pairs, groups: plans.append(plan_lines(pairs, "HashAggregate")) or bitmaps(pairs, groups))
    writers.upsert(spark, rows, str(tmp_path / "int"), rows.schema)
    measures.refresh_distinct(spark, str(tmp_path / "int"), rows.schema, str(tmp_path / "d"))
    assert plans == [[], []]
    found = measures.distinct_counts(spark, str(tmp_path / "d"), rows.schema, ["plan_id", "service_month"])
    assert {row.service_month: (row.distinct_member_id, row.distinct_provider_npi) for row in found.collect()} == {1: (2, 1), 2: (1, 2)}


def test_members_of_copies_are_counted_by_marks(spark, monkeypatch):
    lines, plain = [], summary.summarize
    monkeypatch.setattr(summary, "summarize", lambda *a, **options: lines.append(options.get("member_first")) or plain(*a, **options))
    found = catalog.with_copies(spark, SF, "unique_members")
    marked = {tuple(row)[:-1]: row.unique_members for row in found.collect()}
    monkeypatch.undo()
    assert lines == ["first"]
    base = models.int_claims(models.stg_claims(catalog.all_facts(spark, SF)), None, None, catalog.RUN_DATE)
    counted = summary.summarize(base, measures=["unique_members"]).collect()
    assert marked == {tuple(row)[:-1]: row.unique_members for row in counted}
