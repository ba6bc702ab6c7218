from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from claimforge.operators import cleaning, merge, scd2
from claimforge.operators.latest import latest_per_key
from claimforge.testtables import catalog
from claimforge.testtables import claims as src
from claimforge.testtables.oracles import ORACLES
from tests.compare import connect, differences

SMALL = "/root/testdata/sf0.001"
CHECKED = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_query_has_its_sql():
    assert set(catalog.CATALOG) == set(ORACLES)
    assert set(catalog.CATALOG) <= set(driver.queries()) and set(ORACLES) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(catalog.CATALOG))
def test_query_equals_sql(spark, con, name):
    assert differences(driver.queries()[name](spark, SMALL), con, driver.oracle_sql()[name]) == []


def test_entry(spark):
    df = driver.entry(spark)
    assert df.count() > 0 and df.columns[-1] == "updated_at"


def test_known_counts(spark):
    """Counts that two engines agreed on before this code existed."""
    rows = src.claims(spark, CHECKED, *src.BATCH, *src.TIES)
    valid = cleaning.drop_negative(cleaning.require(rows))
    assert (rows.count(), valid.count()) == (60000, 56434)
    assert latest_per_key(valid, ties=src.TIES).count() == 43784
    found = catalog.enriched(spark, CHECKED)
    kinds = {r.claim_category: r["count"] for r in found.groupBy("claim_category").count().collect()}
    assert kinds == {
        "high_cost_medical": 5212, "out_of_network": 8573, "pharmacy": 8755, "standard": 21244,
    }
    assert catalog.CATALOG["mart_claims_summary"](spark, CHECKED).count() == 32883


def test_known_merge_counts(spark):
    actions = merge.merge_actions(*catalog.halves(spark, CHECKED)).groupBy("action").count()
    assert {r.action: r["count"] for r in actions.collect()} == {
        "kept": 36008 - 5015, "updated": 5015, "inserted": 14839 - 5015,
    }


def test_known_history_counts(spark):
    history = catalog.CATALOG["scd2_build"](spark, CHECKED)
    assert (history.count(), history.where("is_current").count()) == (12286, 1500)
    orders = src.table(spark, CHECKED, "orders")
    lines = src.table(spark, CHECKED, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", F.col("l_shipdate").cast("date").alias("day")
    )
    facts = lines.join(orders, "o_orderkey").select(
        F.concat(F.lit("M"), "o_custkey").alias("member_id"), "day", "l_linenumber"
    )
    history = scd2.build_history(src.member_changes(spark, CHECKED), **catalog.HISTORY)
    joined = scd2.as_of_join(facts, history, "member_id", "day", ["l_linenumber", "day"])
    assert (joined.count(), joined.where("valid_from is not null").count()) == (60000, 54832)


def test_mart_totals_equal_their_base(spark):
    mart = catalog.CATALOG["agg_sums"](spark, SMALL).toPandas()
    base = catalog.CATALOG["int_claims_enriched"](spark, SMALL).toPandas()
    assert mart.total_paid.sum() == pytest.approx(base.paid_amount.sum())
    assert mart.total_billed.sum() == pytest.approx(base.billed_amount.sum())
