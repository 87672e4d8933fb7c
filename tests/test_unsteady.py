"""Queries that rank by ranges agree with their SQL whatever the approximate quantiles are."""

import pytest
from oracle import compare, connect
from pyspark.sql import functions as F

import __spark_entry__ as entry

RANKED = ["perturb_utest_balanced", "perturb_utest_guide", "fake_perturbation", "fdr_bh", "fdr_storey", "fdr_storey_smooth"]


@pytest.mark.parametrize("name", RANKED)
def test_query_when_quantiles_come_out_differently_each_time(spark, data, monkeypatch, name):
    # parts of several executors arrive in any order, so two branches of a plan can see different approximate quantiles
    real = F.percentile_approx
    chance = F.reflect(F.lit("java.lang.Math"), F.lit("random")).cast("double")
    monkeypatch.setattr(F, "percentile_approx", lambda *a: F.transform(real(*a), lambda c: c * (0.5 + chance / 2)))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert compare(entry.queries()[name](spark, data), connect(data), entry.oracle_sql()[name]) == ""
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
