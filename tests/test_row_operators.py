from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from claimforge import functions as fn
from claimforge.operators import cleaning
from claimforge.operators.enrich import categorize, derive


def ids(df):
    return {row.claim_id for row in df.collect()}


def test_required_keys(sample):
    assert ids(cleaning.require(sample)) == {"A-1", "A-2", "A-3", "A-5", "A-6", "A-7"}


def test_amounts_below_zero_missing_or_no_number(sample):
    assert ids(cleaning.drop_negative(sample, "billed_amount")) == {"A-1", "A-2", "A-3", "A-4", "A-7"}


def test_amounts_beyond_the_money_type(spark):
    texts = ["NaN", "Infinity", "-Infinity", "1e16", "999999999999999", "1e20"]
    df = spark.createDataFrame([(t, float(t)) for t in texts], "claim_id string, billed_amount double")
    assert ids(cleaning.drop_negative(df, "billed_amount")) == {"999999999999999"}
    assert [r.m for r in df.select(fn.money("billed_amount").alias("m")).collect()].count(None) == 5


def test_negative_or_missing_amount_drops_the_row(spark):
    df = spark.createDataFrame(
        [("a", 1.0, None), ("b", None, 1.0), ("c", 0.0, 0.0), ("d", 1.0, -0.01)],
        "claim_id string, billed_amount double, paid_amount double",
    )
    assert ids(cleaning.drop_negative(df)) == {"c"}


def test_empty_text_is_a_key(spark):
    df = spark.createDataFrame([("", "m"), (None, "m"), ("x", None)], "claim_id string, member_id string")
    assert [row.claim_id for row in cleaning.require(df).collect()] == [""]


def test_clean_keeps_valid_rows(sample):
    texts = sample.withColumns(
        {name: F.col(name).cast("string") for name in ("service_date", "discharge_date")}
    )
    out = cleaning.clean(texts, "2023-06-01", "test", "2023-06-01 01:00:00")
    assert ids(out) == {"A-1", "A-2", "A-3"} and out.count() == 4
    row = out.where("claim_id = 'A-2'").first()
    assert (row.run_date, row.env, str(row.ingested_at)) == ("2023-06-01", "test", "2023-06-01 01:00:00")


def test_bad_date_becomes_null(spark):
    df = spark.createDataFrame([("2024-13-01",), ("2024-02-29",), ("x",), (None,)], "service_date string")
    days = [row.service_date for row in cleaning.type_dates(df, "service_date").collect()]
    assert [str(day) for day in days] == ["None", "2024-02-29", "None", "None"]


def reference_flags(sample):
    return derive(sample.withColumn("network_flag", F.lit(None).cast("string")))


def by_month(df):
    return {(row.claim_id, row.service_month): row for row in df.collect()}


def test_flags(sample):
    rows = by_month(reference_flags(sample))
    assert {k for k, row in rows.items() if row.denied_flag} == {("A-3", 4), ("A-1", 5)}
    assert {k for k, row in rows.items() if row.high_cost_flag} == {("A-2", 3)}
    assert all(row.out_of_network_flag is None for row in rows.values())


def test_stay_ratio_and_period(sample):
    rows = by_month(reference_flags(sample))
    stays = {k: row.length_of_stay_days for k, row in rows.items() if row.length_of_stay_days is not None}
    assert stays == {("A-1", 3): 3, ("A-2", 3): 0, ("A-1", 5): -2}
    assert rows["A-1", 3].cost_ratio == 0.8333 and rows["A-1", 5].cost_ratio == 0.25
    assert rows["A-3", 4].cost_ratio is None and rows["A-5", 4].cost_ratio is None
    assert {row.service_year for row in rows.values()} == {2023}


def test_threshold_is_strict_and_zero_billed_has_no_ratio(spark):
    df = spark.createDataFrame(
        [(10000.0, 0.0), (10000.01, 20000.0)], "paid_amount double, billed_amount double"
    )
    rows = df.select(fn.is_high_cost().alias("high"), fn.ratio("paid_amount", "billed_amount").alias("r"))
    assert [tuple(row) for row in rows.collect()] == [(False, None), (True, 0.5)]


def test_denied_reads_the_stored_status_unless_told(sample):
    padded = sample.withColumns(
        {"claim_status": F.lit(" denied "), "network_flag": F.lit("IN")}
    ).limit(1)
    assert derive(padded).first().denied_flag is False
    assert derive(padded, normalize_first=True).first().denied_flag is True


@pytest.mark.parametrize(
    ("kind", "high", "out", "expected"),
    [
        ("medical", True, True, "high_cost_medical"),
        ("medical", None, True, "out_of_network"),
        ("pharmacy", True, True, "pharmacy"),
        ("dental", True, None, "standard"),
        (None, True, False, "standard"),
    ],
)
def test_category(spark, kind, high, out, expected):
    df = spark.createDataFrame(
        [(kind, high, out)], "claim_type string, high_cost_flag boolean, out_of_network_flag boolean"
    ).withColumn("service_date", F.lit("2024-01-01").cast("date"))
    row = categorize(df, "2024-01-31").first()
    assert (row.claim_category, row.days_since_service) == (expected, 30)


def test_mask(sample):
    masked = cleaning.mask_members(sample)
    found = {row.member_id for row in masked.collect()}
    assert None in found
    found.discard(None)
    assert found == {hashlib.sha256(m.encode()).hexdigest() for m in ("P10", "P11", "P12", "P13")}
    assert {len(value) for value in found} == {64}
    keyed = {row.member_id for row in cleaning.mask_members(sample, "k").collect()}
    assert not found & keyed


def test_digest_of_any_type(spark):
    row = spark.range(7, 8).select(fn.digest("id").alias("d")).first()
    assert row.d == hashlib.sha256(b"7").hexdigest()


def test_text(spark):
    df = spark.createDataFrame(
        [(" a10 , b2,, ", " Behavioral "), (None, "hospice")], "codes string, claim_type string"
    )
    rows = df.select(fn.code_list("codes").alias("codes"), fn.standard_claim_type().alias("kind")).collect()
    assert [(row.codes, row.kind) for row in rows] == [(["A10", "B2"], "BEHAVIORAL"), (None, None)]
    piped = spark.createDataFrame([("a|b",)], "codes string").select(fn.code_list("codes", "|").alias("c"))
    assert piped.first().c == ["A", "B"]
