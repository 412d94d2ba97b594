"""Queries that judge rows against the store judge every row of the table, not only those that the store lacks."""

from curaspark.plans import registry, views


def _counts(spark, sf, name, key):
    return {r[key]: r["n"] for r in registry.queries()[name](spark, sf).groupBy(key).agg({"n": "sum"}).toDF(key, "n").collect()}


def test_row_flags_of_every_row(spark, sf):
    hosts, got = views.table(spark, sf, "v_hosts"), _counts(spark, sf, "row_flags", "flag")
    assert got["host_missing"] == hosts.filter("SPECIES_NAME = ''").count()
    assert got["prevalence_inconsistent"] == hosts.filter("NUMBER_FOUND > NUMBER_TESTED").count()


def test_plausibility_of_every_row(spark, sf):
    claim = ["LINEAGE_NAME", "SPECIES_NAME", "COUNTRY_NAME"]
    judged = {tuple(r) for r in registry.queries()["plausibility"](spark, sf).select(claim).collect()}
    assert judged == {tuple(r) for r in views.table(spark, sf, "v_hosts").select(claim).distinct().collect()}


def test_backfill_taxonomy_of_every_row(spark, sf):
    hosts = views.table(spark, sf, "v_hosts").groupBy("GENUS_NAME").count()
    assert _counts(spark, sf, "backfill_taxonomy", "GENUS_NAME") == {r[0]: r[1] for r in hosts.collect()}


def test_backfill_continent_of_every_row(spark, sf):
    hosts = views.table(spark, sf, "v_hosts").groupBy("COUNTRY_NAME").count()
    assert _counts(spark, sf, "backfill_continent", "COUNTRY_NAME") == {r[0]: r[1] for r in hosts.collect()}
