"""The regressions and groups of the randomisation test."""

import numpy as np
from pyspark.sql import functions as F

from sparkloom.operators import calibration as C


def screen(spark, n=80):
    rng = np.random.default_rng(2)
    cells = spark.createDataFrame([(i, f"c{i % 2}", float(rng.normal()), float(rng.random())) for i in range(n)], "cell_id long, condition string, a double, b double")
    treated = spark.createDataFrame([(i, f"t{t}") for i in range(n) for t in range(5) if rng.random() < 0.2], "cell_id long, target string")
    clr = spark.createDataFrame([(i, f"p{j}", float(rng.normal())) for i in range(n) for j in range(3)], "cell_id long, program string, clr double")
    return cells, treated, clr


def test_all_regressions_at_once_equal_single_ones(spark):
    cells, treated, _ = screen(spark)
    rows = cells.select("cell_id", "condition", F.array(F.lit(1.0), "a", "b").alias("x")).join(treated.groupBy("cell_id").agg(F.collect_set("target").alias("own")), "cell_id", "left").repartition(3)
    got = C.logistic_all(rows, [f"t{i}" for i in range(5)], 3)
    every = rows.collect()
    for c in ("c0", "c1"):
        x = np.array([r.x for r in every if r.condition == c])
        for i in range(5):
            t = np.array([float(f"t{i}" in (r.own or [])) for r in every if r.condition == c])
            assert np.allclose(got[c][i], C.logistic_weights(x, t), atol=1e-9)


def test_groups_of_targets_give_the_same_result(spark, monkeypatch):
    cells, treated, clr = screen(spark)
    run = lambda: {(r.condition, r.target, r.program): (r.beta, r.pval, r.skew_pval) for r in C.randomisation_test(clr, cells, treated, ["a", "b"], draws=40).collect()}
    whole = run()
    monkeypatch.setattr(C, "HELD", 500)
    again = run()
    assert len(whole) == 30 and whole.keys() == again.keys() and all(np.allclose(whole[k], again[k]) for k in whole)
    assert C.randomisation_test(clr, cells, treated.limit(0), ["a"], draws=4).count() == 0
