"""Whitening and hard negatives against brute force, url filters against SQL, planted cases and odd rows."""

import numpy as np
import oracle
import pytest
from pyspark.sql import functions as F

from sparkloom.llm import hard_negatives, url_filter, whitening
from sparkloom.llm.hard_negatives import Mining
from sparkloom.llm.url_filter import Propagation, Rule
from sparkloom.llm.whitening import Spectrum


def scatter(x):
    away = x - x.mean(0)
    return away.T @ away


def rebuilt(s):
    return s.vectors @ np.diag(s.values) @ s.vectors.T


RNG = np.random.default_rng(5)
SHAPES = {
    "full": (RNG.normal(size=(400, 24)) * np.linspace(1, 40, 24) * 9).astype(np.int64),
    "few rows": RNG.integers(0, 900, (4, 16)),
    "one row": RNG.integers(0, 900, (1, 5)),
    "all alike": np.tile(RNG.integers(0, 900, (1, 6)), (30, 1)),
    "axes": np.eye(8, dtype=np.int64)[RNG.integers(0, 8, 200)],
    "bits": RNG.integers(0, 2, (300, 7)),
    "one entry": RNG.integers(0, 3, (50, 1)),
    "hot": np.concatenate([np.tile(RNG.integers(0, 900, (1, 9)), (200, 1)), RNG.integers(0, 900, (60, 9)), np.tile(RNG.integers(0, 900, (1, 9)), (200, 1))]),
    "wide range": (RNG.normal(size=(200, 6)) * np.array([1, 1, 10, 1e3, 1e6, 1e9])).astype(np.int64),
}


@pytest.mark.parametrize("name", SHAPES)
def test_rank_one_updates_equal_the_decomposition_of_the_scatter(name):
    x = SHAPES[name]
    whole, left, right = (Spectrum.empty(x.shape[1]) for _ in range(3))
    for i, row in enumerate(x):
        whole.add(row)
        (left if i % 3 else right).add(row)
    left.combine(right)
    want = scatter(x)
    top = max(np.abs(want).max(), 1)
    for s in (whole, left):
        assert s.n == len(x) and (s.sums == x.sum(0)).all()
        assert np.abs(rebuilt(s) - want).max() <= 1e-11 * top
        assert np.abs(s.vectors.T @ s.vectors - np.eye(x.shape[1])).max() < 1e-11
        assert (np.diff(s.values) >= 0).all()


def test_roots_lie_between_the_poles():
    poles, weights = np.array([0.0, 1.0, 1.0 + 1e-9, 5.0]), np.array([1e-12, 2.0, 1e-3, 4.0])
    g = whitening.roots(poles, weights)
    for i in range(4):
        root = poles[i] - g[i, i]
        assert poles[i] < root or g[i, i] < 0
        assert abs(1 + (weights / g[i]).sum()) <= 1e-11 * (1 + np.abs(weights / g[i]).sum())


def white(spark, rows, k=8):
    df = spark.createDataFrame([(i, None if v is None else [None if e is None else float(e) for e in v]) for i, v in rows], "vec_id long, embedding array<float>").withColumn("n", F.lit("x")).withColumn("x", F.lit("y"))
    return whitening.whiten(df.repartition(3), k=k).collect()


def check_white(found, x, ids, k):
    n, dims = x.shape
    away = n * x - x.sum(0)
    v = scatter(x) / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1]
    by = {(r.vec_id, r.component): r for r in found}
    assert len(found) == len(by) == n * min(k, dims)
    for c in range(1, min(k, dims) + 1):
        want = (x - x.mean(0)) @ u[:, c - 1] / np.sqrt(e[c - 1])
        got = np.array([by[i, c].whitened for i in ids])
        gap = np.abs(np.delete(e, c - 1) - e[c - 1]).min() / e[0] if dims > 1 else 1
        assert np.abs(got - np.sign(got @ want) * want).max() <= 1e-11 / gap
    for i, row in zip(ids, away, strict=True):
        r = by[i, 1]
        assert r.deviation == int((row.astype(object) ** 2).sum()) and r.n == n
        assert abs(r.explained / (e[0] / np.trace(v)) - 1) < 1e-9 and r.identity_error < 1e-8


def test_whitening_query_against_brute_force(spark, data):
    rows = spark.read.parquet(f"{data}/embeddings.parquet").collect()
    x = np.floor(1024 * np.array([r.embedding for r in rows])).astype(np.int64) + 100_000
    check_white(whitening.query(spark, data).collect(), x, [r.vec_id for r in rows], 8)


def test_spectra_without_refinement_are_right_and_needed(spark, data):
    rows = whitening.grid(spark.read.parquet(f"{data}/embeddings.parquet"), "embedding").repartition(40).cache()
    x = np.array([r.x for r in rows.select("x").collect()])
    total = whitening.combine(whitening.spectra(rows), together=4)
    assert total.n == len(x) and np.abs(rebuilt(total) - scatter(x)).max() <= 1e-10 * np.abs(scatter(x)).max()
    other = Spectrum(total.n, total.sums, total.values, np.eye(len(total.sums)))
    with pytest.raises(ArithmeticError):  # the refinement can't stand in for the updates
        whitening.refine(rows, other, 8, passes=2)


def test_refinement_mends_small_errors(spark, data):
    rows = whitening.grid(spark.read.parquet(f"{data}/embeddings.parquet"), "embedding").cache()
    total = whitening.combine(whitening.spectra(rows))
    rough = np.linalg.qr(total.vectors + 1e-4 * np.random.default_rng(1).normal(size=total.vectors.shape))[0]
    found = whitening.refine(rows, Spectrum(total.n, total.sums, total.values, rough), 4)
    assert found.passes > 1 and found.residual < 1e-9


def test_whitening_of_odd_rows(spark):
    rng = np.random.default_rng(3)
    good = [(i, rng.normal(size=5).astype(np.float32)) for i in range(40)]
    good += [(None, good[0][1]), (7, good[7][1])]
    bad = [(100, None), (101, []), (102, [1, 2]), (103, [None] * 5), (104, [1, 2, float("nan"), 4, 5]), (105, [1, 2, 3, float("inf"), 5])]
    found = white(spark, good + bad)
    assert {r.component for r in found} == {1, 2, 3, 4, 5} and len(found) == 42 * 5
    assert {r.vec_id for r in found} == {*range(40), None} and {r.n for r in found} == {42}
    assert white(spark, bad[:1]) == [] and white(spark, []) == []
    x = np.floor(1024 * np.array([v for i, v in good[:40]], np.float64)).astype(np.int64) + 100_000
    check_white(white(spark, good[:40], k=3), x, range(40), 3)
    alike = white(spark, [(i, [1.0, 2.0]) for i in range(5)])
    assert len(alike) == 10 and {(r.whitened, r.explained, r.deviation) for r in alike} == {(None, 0.0, 0)}
    line = white(spark, [(i, [float(i), 2.0 * i]) for i in range(6)])
    assert all((r.whitened is None) == (r.component == 2) for r in line)
    huge = white(spark, [(0, [1e12, 0.0]), (1, [-1e12, 3.0]), (2, [0.0, 1.0])])
    assert all(r.deviation is None for r in huge if r.vec_id < 2)


def brute(rows, how=Mining()):
    """rows: (id, label, ints); the contract, in loops."""
    out = []
    for a, label, q in sorted({(i, lab, tuple(x)) for i, lab, x in rows if i % 100 == 0}):
        score = [(-sum(p * r for p, r in zip(q, x, strict=True)), i, lab) for i, lab, x in rows]
        for s, p, _ in sorted(t for t in score if t[2] == label and t[1] != a)[: how.positives]:
            fits = sorted(t for t in score if t[2] != label and how.low * -s <= 100 * -t[0] <= how.high * -s)
            out += [(a, p, r + 1, i, -s, -t) for r, (t, i, _) in enumerate(fits[: how.negatives])]
    return sorted(out)


COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def mined(spark, rows, how=Mining(), scale=1):
    df = spark.createDataFrame([(i, lab, None if x is None else [None if e is None else float(e) for e in x]) for i, lab, x in rows], "vec_id long, label int, embedding array<double>").withColumns({"id": F.lit("x"), "block": F.lit(1), "score": F.lit(2)})
    ready = hard_negatives.prepare(df, "vec_id", "embedding", "label", scale)
    return sorted(tuple(r) for r in hard_negatives.mine(ready, ready.filter("id % 100 = 0"), how).select(*COLUMNS).collect())


def test_mining_query(spark, data):
    assert oracle.compare(hard_negatives.query(spark, data), oracle.connect(data), hard_negatives.ORACLE) == ""


@pytest.mark.parametrize("spread", [3, 60])
def test_mining_with_small_blocks_buckets_and_ties(spark, spread):
    rng = np.random.default_rng(spread)
    centres = rng.integers(-spread, spread + 1, (6, 8))
    rows = [(i, int(lab), (centres[lab] * rng.integers(1, 4) + rng.integers(-spread, spread + 1, 8)).tolist()) for i, lab in enumerate(rng.integers(0, 6, 700))]
    how = Mining(scale=1, bucket_rows=16, block_rows=60, block_anchors=2, focus=3)
    assert mined(spark, rows, how) == brute(rows, how)


def test_a_hot_vector_and_a_hot_label(spark):
    rng = np.random.default_rng(9)
    rows = [(i, 0 if i % 3 else 1, [5, 5, -3, 2]) for i in range(300)] + [(i, i % 4, rng.integers(-6, 7, 4).tolist()) for i in range(300, 650)]
    how = Mining(scale=1, bucket_rows=32, block_rows=100)
    assert mined(spark, rows, how) == brute(rows, how)


def test_candidates_lose_no_row():
    rng = np.random.default_rng(2)
    x = rng.integers(-40, 41, (500, 6))
    x[:5] = 0
    lengths = np.sqrt((x.astype(float) ** 2).sum(1))
    by = np.argsort(-lengths)
    pruned = 0
    for part in np.array_split(by, 6):
        b = hard_negatives.Bucket(part, part * 0, x[part], lengths[part])
        for q in [*x[50:60], x[0] * 0]:
            length = float(np.sqrt((q.astype(float) ** 2).sum()))
            unit = q / length if length else q.astype(float)
            for theta in (-5000.0, -10.0, 0.0, 1.0, 1500.0, 3000.0, 1e9):
                got = b.candidates(unit, length, np.argsort(-np.abs(unit))[:3], theta)
                want = set(np.flatnonzero(x[part] @ q >= theta))
                assert got is None or want <= set(got.tolist())
                pruned += got is not None and len(got) < len(part)
    assert pruned > 100


def test_mining_of_odd_rows(spark):
    good = [(0, 1, [3, 4]), (1, 1, [3, 3]), (1, 1, [3, 3]), (2, 2, [2, 2]), (2, 2, [2, 2]), (3, 2, [1, 2]), (200, 3, [1, 1]), (300, 1, [0, 0]), (4, 1, [-3, -4]), (0, 1, [3, 4])]
    bad = [(400, None, [1, 2]), (401, 1, None), (402, 1, [None, 2]), (403, 1, [float("nan"), 1]), (404, 1, [float("inf"), 1]), (405, 1, []), (None, 1, [1, 2])]
    assert mined(spark, good + bad) == brute(good)
    assert mined(spark, bad) == [] and mined(spark, []) == [] and mined(spark, good[1:4]) == []
    big = [(0, 1, [2**31, 1]), (1, 1, [2**30, 3]), (2, 2, [2**29 + 1, 7]), (3, 2, [2**29, 8])]
    assert mined(spark, big) == brute(big) != []


def test_url_query(spark, data):
    assert oracle.compare(url_filter.query(spark, data), oracle.connect(data), url_filter.ORACLE) == ""


URLS = [
    (1, "http://a.example.com/de/1", '<a href="//spam.net/">x</a>'),
    (2, "HTTPS://WWW.Example.ORG/es/x?y#z", ""),
    (3, "http://example.org/en/17", None),
    (4, "http://notexample.org/es/", ""),
    (5, "http://org", ""),
    (6, None, '<a href="http://b.net/">x</a>'),
    (7, "no scheme/de/", ""),
    (8, "://", ""),
    (9, "x://h://k/é?q", ""),
    (10, "http://b.net/en", "<A class=x HREF = ' http://a.example.com/de?x'>y</A><a data-href='//data.net'>"),
    (11, "http://c.net/en", '<a href="https://b.net/1"><a href="https://b.net/2">'),
    (12, "http://d.net/", '<a href="/de/">'),
    (13, "http://Ä.COM/fr/é", ""),
    (13, "http://Ä.COM/fr/é", ""),
    (None, "http://e.org?x", ""),
]


def pages(spark, rows, tmp=None):
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"rule": F.lit("x"), "host": F.lit(1), "score": F.lit(2), "kind": F.lit(3)})


def test_urls_of_odd_rows(spark, tmp_path):
    df = pages(spark, URLS).select("page_id", "url", "html")
    df.write.parquet(f"{tmp_path}/pages.parquet")
    got = url_filter.judge(pages(spark, URLS))
    rows = {r.page_id: r for r in got.collect()}
    assert got.count() == len(URLS)
    assert [(rows[i].host, rows[i].path, rows[i].rule) for i in (1, 2, 3, 4, 5)] == [("a.example.com", "/de/1", "com/de/"), ("www.example.org", "/es/x", "example.org/es/"), ("example.org", "/en/17", "example.org/en/1"), ("notexample.org", "/es/", "org/"), ("org", "", None)]
    assert [(rows[i].host, rows[i].path) for i in (6, 7, 8, 9, 13)] == [("", ""), ("", ""), ("", ""), ("h:", "//k/é"), ("Ä.com", "/fr/é")]
    assert (rows[None].host, rows[None].path, rows[None].rule) == ("e.org", "", None)
    assert url_filter.judge(pages(spark, [])).collect() == []
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    assert oracle.compare(url_filter.judge(df), con, url_filter.ORACLE) == ""


def test_distrust_goes_against_links_and_trust_along_them(spark):
    rows = {r.page_id: r for r in url_filter.judge(pages(spark, URLS)).collect()}
    assert rows[10].verdict == "block" and rows[11].verdict == "block"  # they link to a blocked host, one of them at second hand
    assert rows[12].verdict == "allow" and rows[12].distrust == 0
    linked = [(1, "http://good.com/fr/", '<a href="//new.net/">'), (2, "http://new.net/", '<a href="//bad.com/">'), (3, "http://bad.com/de/", "")]
    found = {r.page_id: r for r in url_filter.judge(pages(spark, linked)).collect()}
    assert found[2].trust > 0 and found[2].distrust > 0
    assert {url_filter.judge(pages(spark, linked), how=Propagation(threshold=t)).filter("page_id = 2").first().verdict for t in (1, 10_000)} == {"allow", "block"}


def test_scores_by_brute_force(spark):
    rng = np.random.default_rng(4)
    hosts = [f"h{i}.net" for i in range(20)]
    pairs = {(hosts[a], hosts[b]): int(n) for a, b, n in zip(rng.integers(0, 20, 60), rng.integers(0, 20, 60), rng.integers(1, 5, 60), strict=True) if a != b}
    seeds = spark.createDataFrame([(h, int(i % 4 == 0), int(i % 7 == 1) * 3) for i, h in enumerate(hosts)], "host string, n_allow long, n_block long")
    links = spark.createDataFrame([(*k, n) for k, n in pairs.items()], "src string, dst string, n long")
    none = spark.createDataFrame([], "src string, dst string")
    how = Propagation(rounds=5)
    got = {r.host: (r.trust, r.distrust) for r in url_filter.propagate(seeds, links, none, how).collect()}
    for kind, seed in ((0, {h: (i % 4 == 0) for i, h in enumerate(hosts)}), (1, {h: (i % 7 == 1) * 3 for i, h in enumerate(hosts)})):
        s = np.array([float(seed[h]) for h in hosts])
        m = np.zeros((20, 20))
        for (a, b), n in pairs.items():
            i, j = hosts.index(a), hosts.index(b)
            m[(j, i) if kind == 0 else (i, j)] = n
        m /= np.maximum(m.sum(0), 1)
        x = s
        for _ in range(how.rounds):
            x = s + 0.85 * m @ x
        assert np.abs(np.array([got.get(h, (0, 0))[kind] for h in hosts]) / url_filter.UNIT - x).max() < 1e-3


def test_hosts_with_many_links_are_dealt_out_in_parts(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "PART", 4)
    seeds = spark.createDataFrame([("hub", 10, 0)], "host string, n_allow long, n_block long")
    links = spark.createDataFrame([("hub", f"h{i}", 1) for i in range(50)], "src string, dst string, n long")
    got = url_filter.propagate(seeds, links, spark.createDataFrame([], "src string, dst string"), Propagation(rounds=2)).collect()
    assert len(got) == 51 and {r.trust for r in got if r.host != "hub"} == {10 * url_filter.UNIT * 85 // 100 // 50 + d for d in (0,)}


def test_longest_rules_win_and_of_equally_long_ones_the_longer_host(spark):
    rules = [Rule(True, "b.c", "/x"), Rule(False, "a.b.c", "/"), Rule(True, "c", "/x/yy"), Rule(False, "c", "/x/y")]
    urls = [(1, "http://a.b.c/x/yy", ""), (2, "http://b.c/x/yz", ""), (3, "http://a.b.c/z", ""), (4, "http://q.c/x/y", ""), (5, "http://ab.c/x", "")]
    got = {r.page_id: (r.rule, r.verdict) for r in url_filter.judge(pages(spark, urls), rules).collect()}
    assert got == {1: ("a.b.c/", "block"), 2: ("b.c/x", "allow"), 3: ("a.b.c/", "block"), 4: ("c/x/y", "block"), 5: (None, got[5][1])}
    assert url_filter.judge(pages(spark, urls), []).filter("rule IS NOT NULL OR verdict <> 'allow'").count() == 0


def test_long_hosts_and_hostile_pages(spark):
    rows = [(1, "http://" + "a." * 100_000 + "com/fr/", "<a " * 100_000), (2, "http://x.com/", "<a href=" + " " * 200_000), (3, "http://y.com/", "<a x" + " href" * 50_000)]
    assert url_filter.judge(pages(spark, rows)).count() == 3
