"""Steps whose memory or time grew faster than the tables."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from sparkloom.operators import factor, similarity
from sparkloom.sources import tables


@pytest.fixture
def screen(spark):
    loading = spark.createDataFrame([(str(p), g, float((p * 7 + g * 3) % 11)) for p in range(3) for g in range(30) if (p + g) % 4], "program string, gene_id long, score double")
    counts = spark.createDataFrame([(g, f"m{m}", (g * m) % 5 + 1) for m in range(2) for g in range(30) if (m + g) % 3], "gene_id long, motif string, n long")
    return loading, counts, spark.range(32).select(F.col("id").alias("gene_id"))


def test_loadings_are_dealt_by_gene_into_tasks_of_bounded_size(spark, data, monkeypatch):
    monkeypatch.setattr(tables, "TASK_ROWS", 500, raising=False)
    loading = tables.ScreenL(spark, data).loading
    rows = loading.withColumn("task", F.spark_partition_id()).collect()
    assert len({r.task for r in rows}) >= 6000 // 500 and len({(r.gene_id, r.task) for r in rows}) == len({r.gene_id for r in rows})


@pytest.mark.parametrize("correlation", ["pearson", "spearman"])
def test_motif_counts_are_matched_in_tasks_of_bounded_size(spark, screen, monkeypatch, correlation):
    monkeypatch.setattr(tables, "TASK_ROWS", 10, raising=False)
    dealt = []
    monkeypatch.setattr(factor, "dealt", lambda *a: dealt.append(tables.dealt(*a)) or dealt[-1], raising=False)
    found = factor.motif_enrichment(*screen, correlation=correlation).count()
    assert found == 6 and len(dealt) == 2 and all(df.rdd.getNumPartitions() >= 10 for df in dealt)


@pytest.mark.parametrize("correlation", ["pearson", "kendall"])
def test_motif_tests_are_computed_once(spark, screen, correlation):
    found = factor.motif_enrichment(*screen, correlation=correlation)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert found.count() == 6 and "Pandas" not in plan and "ArrowEval" not in plan  # adjusting p-values doesn't compute them again


def test_components_are_found_without_reading_counts_again(spark):
    import numpy as np

    x = np.random.default_rng(5).integers(0, 4, (40, 12)) * (np.arange(40) % 3 > 0)[:, None]
    x[:, 0] = np.arange(40) % 5  # not among the chosen genes, so some cells have no entry
    expr = spark.createDataFrame([(c, g, float(x[c, g])) for c in range(40) for g in range(12) if x[c, g]], "cell_id long, gene_id long, count double")
    genes = spark.range(1, 12).select(F.col("id").alias("gene_id"))
    rows, mean, scale = factor.prepare_log(expr, genes)
    assert "Join" not in rows._jdf.queryExecution().optimizedPlan().toString()  # a pass over the cells reads them, it doesn't build them
    got = {r.cell_id: r.pc for r in factor.pca(rows, 11, 3, mean, scale).collect()}
    kept = np.flatnonzero(x.sum(1))
    v = np.log1p(1e4 * x[kept] / x[kept].sum(1, keepdims=True))[:, 1:]
    z = (v - v.mean(0)) / v.std(0)
    axes = np.linalg.svd(z, full_matrices=False)[2][:3].T
    axes *= np.where(np.take_along_axis(axes, np.abs(axes).argmax(0)[None], 0) < 0, -1, 1)
    assert sorted(got) == kept.tolist() and (v.sum(1) == 0).any()
    assert np.abs(np.array([got[c] for c in kept]) - z @ axes).max() < 1e-4


def test_products_of_a_reconstruction_meet_in_tasks_of_bounded_size(spark, monkeypatch):
    monkeypatch.setattr(tables, "TASK_ROWS", 10, raising=False)
    expr = spark.createDataFrame([(c, g, float((c * g) % 7 + 1)) for c in range(9) for g in range(8) if (c + g) % 3], "cell_id long, gene_id long, count double")
    usage = spark.createDataFrame([(c, str(p), c + p / 2) for c in range(10) for p in range(3) if (c + p) % 2], "cell_id long, program string, score double")
    loading = spark.createDataFrame([(str(p), g, g - p / 4) for p in range(3) for g in range(9)], "program string, gene_id long, score double")
    want = similarity.reconstruction_error(expr, usage, loading).first().error
    monkeypatch.setattr(similarity, "DENSE_ENTRIES", 0)
    dealt = []
    monkeypatch.setattr(similarity, "dealt", lambda *a: dealt.append(tables.dealt(*a)) or dealt[-1], raising=False)
    assert abs(similarity.reconstruction_error(expr, usage, loading).first().error - want) < 1e-6 * want
    assert len(dealt) == 6 and sum(df.rdd.getNumPartitions() > 4 for df in dealt) >= 2


def test_documents_are_parsed_once(spark, data):
    plan = entry.queries()["regulator_evidence"](spark, data)._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json" not in plan
