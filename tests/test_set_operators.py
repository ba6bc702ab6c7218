from __future__ import annotations

import datetime as dt
import statistics
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from claimforge.operators import merge, quality, scd2, summary
from claimforge.operators.latest import latest_per_key
from claimforge.operators.lookup import hot_keys, lookup
from claimforge.operators.median import exact_median


def rows(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


# Lookup -------------------------------------------------------------------


@pytest.fixture
def skewed(spark):
    """A third of the rows on one key, a third on NULL."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.col("id").cast("string"))
    return spark.range(9000).select(F.col("id").alias("row"), key.alias("k"))


@pytest.fixture
def dim(spark):
    return spark.createDataFrame(
        [("hot", "h", None), ("1", "one", 1), ("4", None, 4), ("x", "unused", 0)],
        "k string, name string, n int",
    )


def test_hot_keys_include_null(skewed):
    assert set(hot_keys(skewed, "k")["k"]) == {"hot", None}


def test_hot_keys_of_nothing(skewed):
    assert hot_keys(skewed.where("false"), "k", "row") == {"k": [], "row": []}


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
@pytest.mark.parametrize("hot", [["hot", None], [None], ["hot"], ["hot", "4", "absent"]])
def test_route_does_not_change_the_result(spark, skewed, dim, hot, threshold):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        plain = lookup(skewed, dim, "k")
        routed = lookup(skewed, dim, "k", hot, ["row"])
        assert routed.columns == plain.columns
        assert rows(routed) == rows(plain)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_rows_are_spread(spark, skewed, dim):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        routed = lookup(skewed, dim, "k", ["hot", None])
        sizes = [row["count"] for row in routed.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) == 8
        assert max(sizes) < 2 * 9000 / 8
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_a_hot_key_that_the_dimension_lacks_is_spread(spark, dim):
    facts = spark.range(9000).select(
        F.when(F.col("id") % 3 < 2, "absent").otherwise((F.col("id") % 40).cast("string")).alias("k"), F.col("id").alias("row")
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        routed = lookup(facts, dim, "k", ["absent"], ["row"])
        sizes = [row["count"] for row in routed.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) == 8 and max(sizes) < 2 * 9000 / 8
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_a_hot_key_that_the_dimension_repeats_fails(spark, skewed, dim):
    with pytest.raises(PySparkException, match="repeated k in a dimension"):
        lookup(skewed, dim.unionByName(dim), "k", ["hot"], ["row"]).collect()
    with pytest.raises(ValueError, match="hot keys"):
        lookup(skewed, dim, "k", [str(i) for i in range(5000)])


# Latest -------------------------------------------------------------------


def test_latest_and_ties(spark):
    df = spark.createDataFrame(
        [("a", 1, 5, "x"), ("a", 2, 1, "y"), ("b", 1, 1, "p"), ("b", 1, 2, "q"), ("c", None, 1, "r")],
        "claim_id string, ingested_at int, u int, v string",
    )
    assert rows(latest_per_key(df)) == [("a", 2, 1, "y"), ("b", 1, 2, "q"), ("c", None, 1, "r")]
    assert rows(latest_per_key(df, ties=["v"])) == rows(latest_per_key(df))


def test_copies_are_dropped_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 1).alias("claim_id"), F.col("id").alias("ingested_at"))
    plan = latest_per_key(df)._jdf.queryExecution().executedPlan().toString()
    below_shuffle = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in below_shuffle and "Partial" in below_shuffle


# Merge --------------------------------------------------------------------


@pytest.fixture
def target(spark):
    return spark.createDataFrame([("a", 1, 1), ("b", 5, 1)], "claim_id string, t int, v int")


@pytest.fixture
def source(spark):
    return spark.createDataFrame([(2, "b", 4), (2, "c", 1)], "v int, claim_id string, t int")


def test_merge(target, source):
    assert rows(merge.merge_by_key(target, source)) == [("a", 1, 1), ("b", 4, 2), ("c", 1, 2)]


def test_merge_twice_is_merge_once(target, source):
    once = merge.merge_by_key(target, source)
    assert rows(merge.merge_by_key(once, source)) == rows(once)


def test_merge_newer_only(target, source):
    out = merge.merge_by_key(target, source, only_if_newer="t")
    assert rows(out) == [("a", 1, 1), ("b", 5, 1), ("c", 1, 2)]


def test_merge_actions(target, source):
    assert rows(merge.merge_actions(target, source)) == [
        ("a", "kept"), ("b", "updated"), ("c", "inserted"),
    ]


def test_past_mark(spark):
    runs = spark.createDataFrame([("2024-01-01",), ("2024-01-02",), ("2024-01-03",)], "run_date string")
    seen = runs.where("run_date <= '2024-01-02'")
    empty = runs.where("false")
    assert merge.past_mark(runs, None).count() == 3
    assert rows(merge.past_mark(runs, seen)) == [("2024-01-03",)]
    assert merge.past_mark(runs, seen, inclusive=True).count() == 2
    assert merge.past_mark(runs, empty).count() == 0
    assert merge.past_mark(runs, empty, all_when_empty=True).count() == 3


# Summary ------------------------------------------------------------------

amounts = st.integers(min_value=-(10**18) + 1, max_value=10**18 - 1) | st.integers(-300, 300)
groups = st.lists(st.tuples(st.sampled_from(["a", "b", None]), amounts | st.none()), max_size=40)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(groups)
def test_median(spark, data):
    df = spark.createDataFrame(
        [(g, None if c is None else Decimal(c).scaleb(-2)) for g, c in data],
        "g string, amount decimal(18,2)",
    )
    found = exact_median(df.select(F.struct("g").alias("k"), "amount"), "k", "amount").collect()
    expected = {}
    for g, c in data:
        if c is not None:
            expected.setdefault(g, []).append(c)
    assert {row.k.g for row in found} == set(expected) and len(found) == len(expected)
    for row in found:
        assert row["median"] == pytest.approx(statistics.median(expected[row.k.g]) / 100, rel=1e-12)


def test_median_of_one_large_group(spark):
    df = spark.range(200001).select(
        F.lit(1).alias("g"), ((F.col("id") * 7919) % 200001).cast("decimal(18,2)").alias("amount")
    )
    assert exact_median(df, "g", "amount").first()["median"] == 100000.0


def test_median_of_very_large_amounts(spark):
    """Amounts far beyond 2^40 cents, of both signs, in one group."""
    cents = [2**45, 2**45 + 1, 2**45 + 2**21, -(2**50), -(2**50) + 3, 10**17, 7]
    df = spark.createDataFrame([("a", Decimal(c).scaleb(-2)) for c in cents], "g string, amount decimal(18,2)")
    assert exact_median(df, "g", "amount").first()["median"] == 2**45 / 100
    even = df.where(df.amount != Decimal(7).scaleb(-2))
    assert exact_median(even, "g", "amount").first()["median"] == (2**46 + 1) / 200


def test_median_refuses_what_it_would_round(spark):
    for kind in ("decimal(18,3)", "decimal(20,2)", "double"):
        df = spark.range(3).select(F.lit(1).alias("g"), F.col("id").cast(kind).alias("amount"))
        with pytest.raises(TypeError, match="not a number that fits"):
            exact_median(df, "g", "amount")
    assert exact_median(df.select("g", F.col("amount").cast("int")), "g", "amount").first()["median"] == 1.0


def test_approximate_distinct_counts(spark):
    rows = spark.range(20_000).select(
        F.lit(1).alias("service_year"), F.col("id").cast("string").alias("claim_id"),
        (F.col("id") % 500).cast("string").alias("member_id"), F.lit("n").alias("provider_npi"),
    )
    names = ["total_claims", "unique_members", "unique_providers"]
    row = summary.summarize(rows, ["service_year"], names, distinct="approx").first()
    assert row.total_claims == pytest.approx(20_000, rel=0.15) and row.unique_members == pytest.approx(500, rel=0.15)
    assert row.unique_providers == 1


@pytest.fixture(scope="module")
def base(spark):
    money = Decimal
    return spark.createDataFrame(
        [
            (2024, 1, "p", "medical", "standard", None, "c1", "m1", "n1", money("10.00"), True, None, 1, money("0.5000")),
            (2024, 1, "p", "medical", "standard", None, "c1", "m1", None, money("20.00"), True, True, 2, None),
            (2024, 1, "p", "medical", "standard", "NY", "c2", "m2", "n2", None, None, None, None, None),
        ],
        "service_year int, service_month int, plan_id string, claim_type string, claim_category string,"
        "state string, claim_id string, member_id string, provider_npi string, paid_amount decimal(18,2),"
        "denied_flag boolean, out_of_network_flag boolean, length_of_stay_days int, cost_ratio decimal(8,4)",
    ).withColumns(
        {
            "billed_amount": F.col("paid_amount"),
            "allowed_amount": F.col("paid_amount"),
            "high_cost_flag": F.col("denied_flag"),
            "risk_score": F.lit(1.25),
        }
    )


def test_measures(base):
    found = {row.state: row for row in summary.monthly_summary(base, "2024-02-01").collect()}
    null, ny = found[None], found["NY"]
    assert (null.total_claims, null.unique_members, null.unique_providers) == (1, 1, 1)
    assert (null.total_paid, null.avg_paid_per_claim, null.median_paid_per_claim) == (Decimal("30.00"), 15.0, 15.0)
    # Two denied rows over one distinct claim: the rate counts rows against ids.
    assert (null.denied_claims, null.denial_rate_pct) == (2, 200.0)
    assert (null.out_of_network_claims, null.avg_los_days, null.avg_cost_ratio) == (1, 1.5, 0.5)
    assert (ny.median_paid_per_claim, ny.avg_paid_per_claim, ny.total_paid) == (None, None, None)
    assert (ny.denied_claims, ny.denial_rate_pct, ny.avg_member_risk_score) == (0, 0.0, 1.25)
    assert str(null.updated_at) == "2024-02-01 00:00:00"


def test_unique_claims_shortcut(base):
    once = base.where("claim_id = 'c2' or provider_npi = 'n1'")
    assert rows(summary.summarize(once)) == rows(summary.summarize(once, claims_unique=True))


def test_approximate_median_is_a_value(base):
    row = summary.payer_summary(base, median="approx").first()
    assert row.median_paid_per_claim in (10.0, 20.0)


# Checks -------------------------------------------------------------------


def test_claim_checks(spark):
    df = spark.createDataFrame(
        [("a", "m", -1.0, None, "DENIED", "dental"), ("a", None, None, -5.0, "odd", "hospice"), (None, "m", 0.0, 0.0, None, None)],
        "claim_id string, member_id string, billed_amount double, paid_amount double, claim_status string, claim_type string",
    )
    found = {(r.rule, r.column_name): r.failures for r in quality.count_failures(df, quality.claim_checks()).collect()}
    assert set(found.values()) == {1} and len(found) == 7
    assert rows(quality.duplicates(df)) == [("a", 2)]
    with pytest.raises(ValueError, match="not unique on claim_id"):
        quality.require_unique(df, "claim_id", "claims")
    quality.require_unique(df, "billed_amount", "claims")


def test_mart_checks(spark):
    df = spark.createDataFrame([(1, 100.0), (-1, 100.01), (0, None)], "total_claims long, denial_rate_pct double")
    assert [r.failures for r in quality.count_failures(df, quality.mart_checks()).collect()] == [1, 1]


@pytest.mark.parametrize(("hours", "status"), [(24, "pass"), (25, "warn"), (48, "warn"), (49, "error")])
def test_freshness(spark, hours, status):
    loaded = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(loaded,), (None,)], "ingested_at timestamp")
    row = quality.freshness(df, loaded + dt.timedelta(hours=hours)).first()
    assert (row.status, row.age_hours) == (status, float(hours))
    assert quality.freshness(df.where("false"), loaded).first().status == "error"


def test_trend(spark):
    counts = spark.createDataFrame(
        [(dt.date(2024, 1, 1), 10), (dt.date(2024, 1, 2), 20), (dt.date(2024, 1, 9), 5), (dt.date(2024, 1, 20), 1)],
        "day date, rows long",
    )
    found = {str(r.day)[-2:]: (r.avg_before, r.suspicious) for r in quality.row_count_trend(counts, min_share=0.5).collect()}
    assert found == {"01": (None, None), "02": (10.0, False), "09": (20.0, True), "20": (None, None)}


# Member history -----------------------------------------------------------

SPEC = {"key": "member_id", "day": "day", "attributes": ["plan"], "order": "seq"}


def day(n):
    return dt.date(2024, 1, n)


def changes(spark, *items):
    return spark.createDataFrame(
        [("m", day(n), plan, seq) for n, plan, seq in items],
        "member_id string, day date, plan string, seq int",
    )


def versions(df):
    out = df.orderBy("member_id", "valid_from").collect()
    return [(r.plan, r.valid_from.day, r.valid_to and r.valid_to.day, r.is_current) for r in out]


def test_history(spark):
    sent = changes(spark, (1, "A", 1), (3, "A", 2), (5, "B", 3), (5, "C", 4), (7, None, 5), (9, None, 6))
    assert versions(scd2.build_history(sent, **SPEC)) == [
        ("A", 1, 5, False), ("C", 5, 7, False), (None, 7, None, True),
    ]


def test_apply_changes(spark):
    first = scd2.build_history(changes(spark, (1, "A", 1), (10, "B", 2)), **SPEC)
    other = scd2.build_history(changes(spark, (1, "X", 1)).withColumn("member_id", F.lit("other")), **SPEC)
    history = first.unionByName(other)
    log = changes(spark, (1, "A", 1), (10, "B", 2))
    log = log.unionByName(changes(spark, (1, "X", 1)).withColumn("member_id", F.lit("other")))
    batch = changes(spark, (5, "C", 3), (10, "D", 4), (12, "D", 5))
    applied = scd2.apply_changes(history, log, batch, **SPEC)
    expected = [("A", 1, 5, False), ("C", 5, 10, False), ("D", 10, None, True), ("X", 1, None, True)]
    assert versions(applied) == expected
    assert versions(scd2.apply_changes(applied, log.unionByName(batch), batch, **SPEC)) == expected


def test_a_late_change_between_equal_ones(spark):
    """A on day 1, A again on day 5, then B for day 3: the second A is a version after all."""
    log = changes(spark, (1, "A", 1), (5, "A", 2))
    late = changes(spark, (3, "B", 3))
    applied = scd2.apply_changes(scd2.build_history(log, **SPEC), log, late, **SPEC)
    expected = [("A", 1, 3, False), ("B", 3, 5, False), ("A", 5, None, True)]
    assert versions(applied) == versions(scd2.build_history(log.unionByName(late), **SPEC)) == expected


def test_first_value_null_is_a_version(spark):
    sent = changes(spark, (1, None, 1), (2, "A", 2))
    assert versions(scd2.build_history(sent, **SPEC)) == [(None, 1, 2, False), ("A", 2, None, True)]


def test_as_of_join_over_years(spark):
    history = spark.createDataFrame(
        [
            ("m", "A", dt.date(2020, 6, 1), dt.date(2022, 1, 1)),
            ("m", "B", dt.date(2022, 1, 1), dt.date(2022, 1, 2)),
            ("m", "C", dt.date(2022, 1, 2), None),
            ("n", "Z", dt.date(2021, 1, 1), dt.date(2030, 1, 1)),
        ],
        "member_id string, plan string, valid_from date, valid_to date",
    )
    dates = ["2020-05-31", "2020-06-01", "2021-12-31", "2022-01-01", "2022-01-02", "2029-12-31", "2031-01-01"]
    facts = spark.createDataFrame(
        [(f"{who}{i}", who, dt.date.fromisoformat(d)) for who in ("m", "n") for i, d in enumerate(dates)]
        + [("null", None, dt.date(2021, 1, 1)), ("nodate", "m", None)],
        "claim_id string, member_id string, service_date date",
    )
    assert scd2.hot_slots(facts, history, "member_id", "service_date")
    for hot in ((), [None], ["m@2022", "n@2021", None], scd2.hot_slots(facts, history, "member_id", "service_date")):
        out = scd2.as_of_join(facts, history, "member_id", "service_date", ["claim_id"], hot)
        plans = {row.claim_id: row.plan for row in out.collect()}
        assert [plans[f"m{i}"] for i in range(7)] == [None, "A", "A", "B", "C", "C", "C"]
        assert [plans[f"n{i}"] for i in range(7)] == [None, None, "Z", "Z", "Z", "Z", None]
        assert plans["null"] is None and plans["nodate"] is None and len(plans) == 16
