"""The mart view over facts: fewer rows move, and the rows are those of the plain summary."""

from pyspark.sql import functions as F

from claimforge.operators.latest import latest_per_key
from claimforge.operators.summary import monthly_summary
from claimforge.plans import models
from claimforge.testtables import catalog
from claimforge.testtables import claims as src
from tests.test_moved_bytes import SF, plan_lines


def facts(spark, tmp_path):
    rows = catalog.spelled(catalog.all_facts(spark, SF))
    rows.write.parquet(str(tmp_path / "fact"))
    fact = spark.read.schema(rows.schema).parquet(str(tmp_path / "fact"))
    dims = catalog.cleaning.mask_members(src.dim_members(spark, SF)), src.dim_providers(spark, SF)
    return fact, *dims


def plain(fact, dim_members, dim_providers):
    latest = latest_per_key(models.stg_claims(fact), newest="run_date")
    return monthly_summary(models.int_claims(latest, dim_members, dim_providers, catalog.NOW[:10]), catalog.NOW)


def rows(df):
    return sorted(map(repr, df.collect()))


def test_the_mart_view_expands_no_rows_and_equals_the_plain_summary(spark, tmp_path):
    fact, members, providers = facts(spark, tmp_path)
    models.publish_views(fact, members, providers, catalog.NOW)
    view = spark.table("mart_claims_summary")
    assert not plan_lines(view, "Expand") and plan_lines(plain(fact, members, providers), "Expand")
    found = rows(view)
    assert found == rows(plain(fact, members, providers)) and len(found) > 100


def test_a_repeated_dimension_key_counts_as_before(spark, tmp_path, monkeypatch):
    fact, members, providers = facts(spark, tmp_path)
    # A heavy key that is repeated fails the job.
    monkeypatch.setattr(models, "hot_keys", lambda *columns: {})
    for twice in ((members.unionByName(members), providers), (members, providers.unionByName(providers.limit(3)))):
        models.publish_views(fact, *twice, catalog.NOW)
        assert rows(spark.table("mart_claims_summary")) == rows(plain(fact, *twice))


def test_a_null_key_does_not_repeat(spark):
    dim = spark.createDataFrame([("a",), (None,), (None,)], "k string")
    assert not models.repeats(dim, "k")
    assert models.repeats(dim.unionByName(dim.where(F.col("k") == "a")), "k")
