"""Ranks and blocks whose plan is read more than once."""

import numpy as np
from pyspark.sql import functions as F

from sparkloom.operators import calibration, factor, ranking, similarity
from sparkloom.plans import sources


def test_ranks_when_quantiles_come_out_differently_each_time(spark, monkeypatch):
    # approximate quantiles depend on the order in which executors' parts arrive, so two branches of a plan can see different ones
    real = F.percentile_approx
    chance = F.reflect(F.lit("java.lang.Math"), F.lit("random")).cast("double")
    monkeypatch.setattr(F, "percentile_approx", lambda *a: F.transform(real(*a), lambda c: c * (0.5 + chance / 2)))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        values = spark.range(3000).select((F.col("id") % 3).alias("k"), F.floor(F.col("id") / 3).cast("double").alias("value"), F.lit(2).alias("w"))
        got = ranking.distinct_positions(values, ["k"], "value", "w").collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(got) == 3000 and all(r.below == 2 * r.value for r in got)


def test_a_p_value_of_most_rows_is_not_one_task(spark, monkeypatch):
    monkeypatch.setattr(ranking, "HEAVY", 50, raising=False)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.range(0, 1000, 1, 4).select("id", F.when(F.col("id") % 100 == 0, F.col("id") / 1000).otherwise(0.5).alias("p"))
        got = ranking.benjamini_hochberg_wide(rows, "p").withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(got) == 1000 and len({r.task for r in got if r.p == 0.5}) > 1
    p = sorted(r.p for r in got)
    for r in got:
        assert r.adj_pval == min(1.0, *(x * 1000 / sum(y <= x for y in p) for x in set(p) if x >= r.p))


def test_motifs_across_sequences_and_pieces_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(factor, "SCANNED", 7, raising=False)
    texts = ["ACGTTACGT", None, "", "AC", "GTCAAGNACGT", "ttcttgacgt", "CAAGCAAG", "CG"]
    seqs = spark.createDataFrame([(f"s{i}", f"g{i % 2}", t) for i, t in enumerate(texts)], "seq_name string, gene_name string, seq string").coalesce(1)
    sharp = lambda word: [[0.97 if b == c else 0.01 for b in "ACGT"] for c in word]
    got = sorted((r.seq_name, r.gene_name, r.motif, r.position, r.strand) for r in factor.scan_motifs(seqs, {"x": sharp("CAAG"), "yy": sharp("ACG")}, p_max=0.016).collect())
    back = str.maketrans("ACGT", "TGCA")
    want = []
    for i, t in enumerate(texts):
        for motif, word in (("x", "CAAG"), ("yy", "ACG")):
            for at in range(len(t or "")):
                for strand, w in (("+", word), ("-", word.translate(back)[::-1])):
                    if t[at : at + len(word)].upper() == w:
                        want.append((f"s{i}", f"g{i % 2}", motif, at, strand))
    assert got == sorted(want) and len(want) > 8


def test_nearest_of_one_file_in_many_tasks_and_pieces(spark, monkeypatch):
    monkeypatch.setattr(similarity, "TASK_PAIRS", 100, raising=False)
    monkeypatch.setattr(factor, "PIECE", (4, 7), raising=False)
    x = np.random.default_rng(8).integers(0, 3, (40, 3)).astype(float)  # many equal distances and a few constant rows
    df = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "id long, v array<double>").coalesce(1)
    for n in (3, 12):
        found = factor.nearest_in_blocks(df, n, factor.distances).withColumn("task", F.spark_partition_id()).collect()
        assert len({r.task for r in found}) > 2
        got = {}
        for r in found:
            got.setdefault(r.a, []).append((r.value, r.b))
        d = factor.distances(x, x)
        for i in range(40):
            want = sorted((d[i, j], j) for j in range(40) if j != i)[:n]
            assert sorted(got[i]) == want


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_correlations_shuffle_no_copies_of_entities(spark, monkeypatch):
    monkeypatch.setattr(similarity, "DENSE_ENTRIES", 40)
    rng = np.random.default_rng(4)
    rows = [(g, str(p), float(rng.random())) for g in range(17) for p in range(5) if rng.random() < 0.8] + [(99, str(p), 1.0) for p in range(5)]
    df = spark.createDataFrame(rows, "gene_id long, program string, score double")
    found = similarity.correlation_in_blocks(df, "gene_id", "program", "score")
    assert "FlatMapGroupsInPandas" not in _plan(found)
    want = {(r.a, r.b): r.r for r in similarity.correlation(df, df, "gene_id", "program", "score").collect()}
    rows = found.collect()
    got = {(r.a, r.b): r.r for r in rows}
    assert len(rows) == len(got) and set(got) == set(want) and sum(r is None for r in got.values()) >= 35
    assert all((got[k] is None) == (want[k] is None) and (got[k] is None or abs(got[k] - want[k]) < 1e-9) for k in want)


def test_gene_effects_in_parts_of_the_genes(spark, monkeypatch):
    rng = np.random.default_rng(2)
    usage = spark.createDataFrame([(c, str(p), float(rng.random())) for c in range(30) for p in range(4) if rng.random() < 0.7], "cell_id long, program string, score double")
    loading = spark.createDataFrame([(str(p), g, float(rng.random())) for p in range(4) for g in range(25) if rng.random() < 0.6], "program string, gene_id long, score double")
    betas = spark.createDataFrame([("0", 0.3), ("2", -0.2)], "program string, beta double")
    want = {r.gene_id: r.effect for r in calibration.gene_effects(usage, loading, betas).collect()}
    monkeypatch.setattr(similarity, "DENSE_ENTRIES", 60)
    found = calibration.gene_effects(usage, loading, betas)
    assert _plan(found).count("MapInPandas") > 1  # no row for a cell and gene
    rows = found.collect()
    got = {r.gene_id: r.effect for r in rows}
    assert len(rows) == len(got) and set(got) == set(want) and all(abs(got[g] - want[g]) < 1e-9 for g in want)


def test_lines_of_wide_matrices_are_filled_in_order(spark):
    rng = np.random.default_rng(3)
    x = {(r, c): float(rng.integers(1, 99)) for r in "abcd" for c in range(13) if rng.random() < 0.4} | {("a", 0): 1.0, ("b", 12): 2.5}
    df = spark.createDataFrame([(r, c, v) for (r, c), v in x.items()], "r string, c long, v double")
    found = sources._wide(df, "r", "c", "v")
    assert "element_at" not in _plan(found)  # a search of the whole row for each column
    head, *lines = [r[0] for r in found.collect()]
    columns = sorted({c for _, c in x})
    assert head == "\t" + "\t".join(map(str, columns))
    assert sorted(lines) == ["\t".join([r, *(str(x.get((r, c), 0.0)) for c in columns)]) for r in "abcd"]


def test_explained_variance_joins_a_gene_once(spark, monkeypatch):
    rng = np.random.default_rng(6)
    loading = spark.createDataFrame([(str(p), g, float(rng.random())) for p in range(4) for g in range(25) if rng.random() < 0.6], "program string, gene_id long, score double")
    expr = spark.createDataFrame([(c, g, float(rng.integers(1, 9))) for c in range(30) for g in range(26) if rng.random() < 0.4], "cell_id long, gene_id long, count double")
    found = lambda: similarity.explained_variance(expr, loading, 30)
    want = {r.program: r.explained for r in found().collect()}
    monkeypatch.setattr(similarity, "DENSE_ENTRIES", 0)
    wide = found()
    assert "s3#" in _plan(wide)  # sums of a cell are columns
    monkeypatch.setattr(similarity, "WIDE", 3)
    for got in (wide, found()):
        got = {r.program: r.explained for r in got.collect()}
        assert set(got) == set(want) and all(abs(got[p] - want[p]) < 1e-9 for p in want)


def test_silhouette_shuffles_no_copies_of_ids(spark, monkeypatch):
    monkeypatch.setattr(similarity, "BLOCK_IDS", 9)
    monkeypatch.setattr(similarity, "PIECE", (4, 3), raising=False)
    rng = np.random.default_rng(6)
    x, label = rng.random((50, 3)), ["b", "a", "c"] * 16 + ["d", None]
    points = spark.createDataFrame([(i, j, float(x[i, j])) for i in range(50) for j in range(3)], "id long, dim int, value double")
    found = similarity.silhouette(points, spark.createDataFrame(list(enumerate(label)), "id long, label string"))
    assert "Generate" not in _plan(found) and "FlatMapGroupsInPandas" not in _plan(found)
    got = {r.id: r.silhouette for r in found.collect()}
    assert len(got) == 50
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    for i in range(50):
        m = {c: np.mean([d[i, j] for j in range(50) if j != i and label[j] == c]) for c in "abcd" if any(j != i and label[j] == c for j in range(50))}
        own, other = m.pop(label[i], None), min(m.values())
        assert abs(got[i] - (0 if own is None else (other - own) / max(own, other))) < 1e-9


def test_matching_takes_treated_cells_in_batches(spark):
    """A target's treated cells, however many, are no group of one task; the matches are those of one sequence."""
    rng = np.random.default_rng(12)
    n = 400
    x, side = rng.normal(size=n), (np.arange(n) % 3 > 0).astype(int)
    cells = spark.createDataFrame([(i % 2, i, int(side[i]), float(x[i])) for i in range(n)], "k int, cell_id long, treated int, x double")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        for caliper, ratio in ((None, 2), (0.1, 1)):
            found = calibration.match(cells, ["k"], ["x"], ratio, caliper).collect()
            got = {(r.pair, r.cell_id) for r in found if not r.treated}
            assert {r.pair for r in found if not r.treated} == {r.cell_id for r in found if r.treated}
            want = set()
            for k in (0, 1):
                own = np.arange(n)[np.arange(n) % 2 == k]
                z = (x[own] - x[own].mean()) / x[own].std()
                p = calibration.logistic(np.c_[np.ones(len(own)), z], side[own].astype(float))
                logit = np.log(p / (1 - p))
                width = np.inf if caliper is None else caliper * logit.std()
                free = [j for j in range(len(own)) if not side[own[j]]]
                for i in sorted((i for i in range(len(own)) if side[own[i]]), key=lambda i: -logit[i]):
                    for _ in range(ratio):
                        j = min(free, key=lambda j: abs(logit[j] - logit[i]), default=None)
                        if j is not None and abs(logit[j] - logit[i]) <= width:
                            free.remove(j)
                            want.add((int(own[i]), int(own[j])))
            assert got == want and len(want) > 50
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_weighted_sums_deal_genes_to_many_tasks(spark, monkeypatch):
    rng = np.random.default_rng(13)
    counts = rng.poisson(2.0, (40, 30))
    expr = spark.createDataFrame([(i, g, float(counts[i, g])) for i in range(40) for g in range(30) if counts[i, g]], "cell_id long, gene_id long, count double")
    cells = spark.createDataFrame([(i, i % 2) for i in range(40)], "cell_id long, treated int")
    found = lambda: {r.gene_id: (r.beta, r.t) for r in calibration.gene_tests(expr, cells, weighted=True, moderated=False).collect()}
    want = found()
    monkeypatch.setattr(calibration, "GENES", 4)
    monkeypatch.setattr(calibration, "SIZES", 9)
    got = found()
    assert set(got) == set(want) and len(got) == 30 and all(np.allclose(got[g], want[g], rtol=1e-9) for g in want)
