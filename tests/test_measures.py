from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimforge.operators import median, numbering
from claimforge.operators.median import exact_median
from claimforge.plans import measures
from claimforge.session import scratch_dir
from claimforge.sources import versions, writers

SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("claim_id", "member_id", "provider_npi", "plan_id", "claim_type", "claim_category", "state", "run_date")]
    + [T.StructField("paid_amount", T.DecimalType(18, 2))]
    + [T.StructField(n, T.IntegerType()) for n in ("service_year", "service_month")]
)


def batch(spark, seed, low, high):
    draw = random.Random(seed)
    rows = [
        (f"c{i}", f"m{draw.randrange(40)}", draw.choice(["p1", "p2", None]), draw.choice("AB"), "medical", "standard",
         draw.choice(["NY", None]), "r", str(draw.choice([None, 10, 10.5, draw.randrange(100000) / 100])), 2024, draw.choice([1, 2, None]))
        for i in range(low, high)
    ]
    names = [f.name for f in SCHEMA.fields]
    frame = spark.createDataFrame(rows, ", ".join(f"{n} {'int' if n.startswith('service') else 'string'}" for n in names))
    return frame.withColumn("paid_amount", F.expr("try_cast(paid_amount as decimal(18,2))"))


def refreshed(spark, root):
    months = measures.refresh_medians(spark, f"{root}/int", SCHEMA, f"{root}/cents", f"{root}/medians")
    rows = versions.read(spark, f"{root}/int", SCHEMA)
    group = rows.withColumn("g", F.struct(*measures.MART_KEYS))
    expected = exact_median(group, "g", "paid_amount").select("g.*", "median")
    found = versions.read(spark, f"{root}/medians", measures.median_schema(SCHEMA)).select(*expected.columns)
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))
    counts = versions.read(spark, f"{root}/cents", measures.histogram_schema(SCHEMA))
    assert counts.where("n <= 0").count() == 0
    assert (counts.agg(F.sum("n")).first()[0] or 0) == rows.where("paid_amount is not null").count()
    return months


def test_medians_after_batches_with_moves_and_replacements(spark):
    root = scratch_dir(spark, "medians")

    def send(rows):
        writers.upsert(spark, rows, f"{root}/int", SCHEMA, change_columns=measures.FOLLOWED)

    send(batch(spark, 1, 0, 60))
    assert len(refreshed(spark, root)) == 3
    send(batch(spark, 2, 30, 90))
    refreshed(spark, root)
    # One claim, which stays in its month: only that month's counts are read.
    one = versions.read(spark, f"{root}/int", SCHEMA).where("service_month = 1").orderBy("claim_id").limit(1)
    send(one.withColumn("paid_amount", F.lit("777.77").cast("decimal(18,2)")))
    assert refreshed(spark, root) == ["service_year=2024/service_month=1"]
    assert refreshed(spark, root) == []
    # Two writes before the next call; the second's rows are the first's again.
    send(batch(spark, 3, 0, 40))
    send(batch(spark, 4, 0, 40))
    refreshed(spark, root)


def test_medians_after_lost_calls_and_unfollowed_writes(spark, monkeypatch):
    root = scratch_dir(spark, "medians")
    writers.upsert(spark, batch(spark, 1, 0, 50), f"{root}/int", SCHEMA, change_columns=measures.FOLLOWED)
    refreshed(spark, root)
    writers.upsert(spark, batch(spark, 2, 0, 50), f"{root}/int", SCHEMA, change_columns=measures.FOLLOWED)
    publish = versions.publish
    monkeypatch.setattr(versions, "publish", lambda s, p, r: (_ for _ in ()).throw(RuntimeError("lost")) if p.endswith("medians") else publish(s, p, r))
    with pytest.raises(RuntimeError, match="lost"):
        refreshed(spark, root)
    monkeypatch.undo()
    # The counts have the batch, the medians don't.
    writers.upsert(spark, batch(spark, 5, 10, 12), f"{root}/int", SCHEMA, change_columns=measures.FOLLOWED)
    refreshed(spark, root)
    writers.upsert(spark, batch(spark, 3, 0, 50), f"{root}/int", SCHEMA)
    assert len(refreshed(spark, root)) == 3


@pytest.mark.parametrize("most", [1, 3, 1 << 21])
def test_large_and_small_groups_agree(spark, monkeypatch, most):
    monkeypatch.setattr(median, "MOST_VALUES", most)
    draw = random.Random(most)
    groups = {g: [draw.randrange(10 ** draw.randrange(1, 15)) for _ in range(g)] for g in range(1, 9)}
    rows = [(None if g == 8 else g, str(v / 100)) for g, values in groups.items() for v in values]
    frame = spark.createDataFrame(rows, "g int, amount string").withColumn("amount", F.col("amount").cast("decimal(18,2)"))
    frame = frame.withColumn("group", F.struct("g"))
    found = {r.group.g: r.median for r in exact_median(frame, "group", "amount").collect()}
    for g, values in groups.items():
        values = sorted(values)
        assert found[None if g == 8 else g] == (values[(g - 1) // 2] + values[g // 2]) / 200


# Distinct counts ----------------------------------------------------------


def test_rolled_up_counts_equal_counted_ones(spark):
    root = scratch_dir(spark, "distinct")
    built = []
    for seed, low, high in ((1, 0, 60), (2, 30, 90), (3, 10, 12)):
        writers.upsert(spark, batch(spark, seed, low, high), f"{root}/int", SCHEMA)
        built.append(measures.refresh_distinct(spark, f"{root}/int", SCHEMA, f"{root}/d", ["plan_id", "state"]))
        rows = versions.read(spark, f"{root}/int", SCHEMA)
        for groups in (["plan_id"], ["service_year", "state"], ["plan_id", "service_year", "service_month"]):
            found = measures.distinct_counts(spark, f"{root}/d", SCHEMA, groups, ["plan_id", "state"])
            counted = rows.groupBy(*groups).agg(
                F.count_distinct("member_id").alias("distinct_member_id"), F.count_distinct("provider_npi").alias("distinct_provider_npi")
            )
            assert sorted(map(str, found.collect())) == sorted(map(str, counted.select(*found.columns).collect()))
    assert len(built[0]) == 3 and measures.refresh_distinct(spark, f"{root}/int", SCHEMA, f"{root}/d", ["plan_id", "state"]) == []


def test_numbers_are_dense_and_stay(spark, monkeypatch):
    monkeypatch.setattr(numbering, "PART_KEYS", 7)
    path = scratch_dir(spark, "numbers")
    seen = {}
    for low, high in ((0, 30), (20, 20), (10, 80), (0, 80)):
        keys = spark.createDataFrame([(f"k{i}",) for i in range(low, high)] * 2 + [(None,)], "key string")
        found = {r.key: r.number for r in measures.number_keys(spark, keys, path).collect()}
        assert seen.items() <= found.items() and sorted(found.values()) == list(range(1, len(found) + 1))
        seen = found
    assert len(seen) == 80


def test_bitmaps_across_buckets(spark):
    rows = spark.range(100_000).select((F.col("id") % 2).alias("g"), (F.col("id") * 7 + 1).alias("number"))
    rows = rows.unionByName(rows).unionByName(spark.createDataFrame([(5, None)], "g long, number long"))
    held = numbering.bitmaps(rows, ["g"])
    assert {r.g: r.n for r in numbering.rolled_up(held, ["g"], "n").collect()} == {0: 50_000, 1: 50_000}
    assert numbering.rolled_up(held.withColumn("all", F.lit(1)), ["all"], "n").first().n == 100_000
