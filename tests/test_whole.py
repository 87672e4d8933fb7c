"""Queries over whole tables, not over the slices that the SQL of others names."""

import numpy as np

from sparkloom.operators import similarity as S
from sparkloom.plans import calibration as C
from sparkloom.plans import factor, registry
from sparkloom.sources import readers as R
from sparkloom.sources.tables import ScreenE, ScreenL

registry.load()


def test_every_target(spark, data):
    s = ScreenL(spark, data)
    pairs = s.assignment.join(s.guides, "guide_name").filter("target <> 'non-targeting'")
    want = {r.target for r in pairs.select("target").distinct().collect()}
    assert len(want) > 3
    # what propensity_matching and matched_effects take; these tables have no control guides to match
    assert {r.target for r in C._screen(spark, data)[1].select("target").distinct().collect()} == want
    found = registry.QUERIES["hurdle_effects"](spark, data).collect()
    assert {r.target for r in found} == want and len(found) == len(want) * s.usage.select("program").distinct().count()


def test_every_gene_and_vector(spark, data):
    s, e = ScreenL(spark, data), ScreenE(spark, data)
    n = s.loading.select("gene_id").distinct().count()
    for name in ("gene_tests", "gene_effects"):
        assert registry.QUERIES[name](spark, data).count() == n
    assert registry.QUERIES["gene_correlation"](spark, data).count() == n * n
    assert registry.QUERIES["stability_silhouette"](spark, data).count() == e.table("embeddings").count() > 200


def test_silhouette_in_blocks_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(S, "BLOCK_IDS", 7)
    rng = np.random.default_rng(5)
    x, label = rng.random((40, 6)) * (rng.random((40, 6)) < 0.6), [*rng.integers(0, 3, 39).tolist(), 9]
    x[:, 0] += 0.1
    points = spark.createDataFrame([(i, j, float(x[i, j])) for i in range(40) for j in range(6) if x[i, j]], "id long, dim int, value double")
    got = {r.id: r.silhouette for r in S.silhouette(points, spark.createDataFrame(list(enumerate(label)), "id long, label int")).collect()}
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    for i in range(40):
        m = {c: np.mean([d[i, j] for j in range(40) if j != i and label[j] == c]) for c in set(label) if any(j != i and label[j] == c for j in range(40))}
        own, other = m.pop(label[i], None), min(m[c] for c in m if c != label[i])
        assert abs(got[i] - (0 if own is None else (other - own) / max(own, other))) < 1e-6


def test_long_gene_sets_and_headers_beside_entries(spark, tmp_path):
    (tmp_path / "long.gmt").write_text("\t".join(["t", "na", *map(str, range(100_003))]) + "\n")
    assert R.read_gmt(spark, str(tmp_path / "long.gmt")).count() == 100_003
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "a").write_text("".join(f"{i} 1 2.0\n" for i in range(1, 400)))
    (tmp_path / "m" / "b").write_text("%%MatrixMarket matrix coordinate real general\n400 1 400\n400 1 2.0\n")
    got = R.read_matrix_market(spark, str(tmp_path / "m")).collect()
    assert sorted(r.row for r in got) == list(range(1, 401)) and {r.column for r in got} == {1}


def test_every_order_part_and_entry(spark, data):
    s = ScreenL(spark, data)
    orders, parts = s.expr.select("cell_id").distinct().count(), s.table("part").count()
    assert registry.QUERIES["gene_mentions"](spark, data).select("pmid").distinct().count() > orders / 2
    assert registry.QUERIES["matrix_market"](spark, data).count() == s.expr.count()
    chunks = factor._sequences(spark, data).select("chunk").collect()
    assert sorted(r.chunk for r in chunks) == list(range(parts))
