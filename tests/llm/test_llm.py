"""The text operators against brute force, exact round trips and held-out rows, and odd inputs."""

import hashlib
import itertools
import json
import random
import re
from collections import Counter, defaultdict

import numpy as np
import oracle
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sparkloom.llm.common import shared_dir
from sparkloom.llm import bpe, chat_format, exact_dedup, html_extract, language_id, minhash_dedup, mixing, quality_rules, queries, secrets_scan, substring_dedup

ODD = [None, "", " \t\n\x0b\x0c\r", "a", "A b", "é日🙂   x", "x " * 30_000, "a" * 50_000, "\u0001\u0002\u0003", "same text", "same text", "sameText", "\0<|endoftext|>"]


def documents(spark, texts=ODD, extra=True):
    rows = [(i, t, None if i % 3 else "en", None if i % 4 else "s", None) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    # columns whose names clash with those that operators add
    return df.withColumns({c: F.lit("x") for c in ("kept", "ids", "decoded", "n_words", "mix_slot", "lang_pred", "size", "run")}) if extra else df


def ids(df, column="doc_id"):
    return sorted((r[0] for r in df.select(column).collect()), key=lambda x: (x is None, x))


@pytest.fixture(scope="module")
def texts(spark, data):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{data}/documents.parquet").collect()}


def words(t):
    return (t or "").encode().split()


# repeats and quality rules


def longest_repeats(w):
    best = [0] * len(w)
    for i, j in itertools.permutations(range(len(w)), 2):
        n = 0
        while max(i, j) + n < len(w) and w[i + n] == w[j + n]:
            n += 1
        best[i] = max(best[i], n)
    return best


def test_suffix_arrays_against_brute_force():
    rng = random.Random(1)
    for _ in range(200):
        docs = [[rng.randrange(rng.choice([1, 2, 6])) for _ in range(rng.randrange(25))] for _ in range(4)]
        flat = np.array(sum(docs, []), np.int64)
        doc = np.repeat(np.arange(4), [len(d) for d in docs])
        assert quality_rules.repeats(flat, doc).tolist() == sum(map(longest_repeats, docs), [])


def longest_spans(w):
    """For each word the longest repeat from there, by growing lengths; no suffix array."""
    best = [0] * len(w)
    alive, n = list(range(len(w))), 1
    while alive:
        seen = Counter(tuple(w[i : i + n]) for i in alive if i + n <= len(w))
        alive = [i for i in alive if i + n <= len(w) and seen[tuple(w[i : i + n])] > 1]
        for i in alive:
            best[i] = n
        n += 1
        if n > 400:
            return longest_repeats(w) if len(w) < 600 else [max(b, m) for b, m in zip(best, quality_rules.repeats(np.unique(np.array(w, dtype=object).astype("S"), return_inverse=True)[1], np.zeros(len(w), np.int64)), strict=True)]
    return best


def test_quality_query(spark, data, texts):
    for r in quality_rules.query(spark, data).collect():
        t = texts[r.doc_id] or ""
        w = words(t)
        seen = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        inside = {j for i in range(len(w) - 7) if seen[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
        lines = [line for line in t.split("\n") if line.encode().split()]
        want = (len(w), sum(len(x.decode()) for x in w), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(inside))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        spans = longest_spans(w)
        covered = {j for i, n in enumerate(spans) if n >= 4 for j in range(i, i + n)}
        assert r.base_failed == (len(w) < 20 or 100 * len(inside) > 30 * len(w))
        assert (r.covered_words, r.longest_repeat) == (len(covered), max(spans, default=0))
        assert r.kept == (not r.base_failed and 100 * len(covered) <= 50 * len(w) and 100 * max(spans, default=0) <= 40 * len(w))


def test_quality_of_odd_rows(spark):
    got = quality_rules.measure(documents(spark))
    assert got.count() == len(ODD) and got.filter("doc_id = 0").first().n_words == 0
    assert got.filter("doc_id = 6").first().longest_repeat == 29_999
    assert quality_rules.quality_filter(documents(spark).limit(0)).collect() == []


# exact dedup


def test_exact_query(spark, data):
    assert oracle.compare(exact_dedup.query(spark, data), oracle.connect(data), exact_dedup.ORACLE) == ""


def test_exact_of_odd_rows(spark):
    got = {r.doc_id: r for r in exact_dedup.duplicate_groups(documents(spark)).collect()}
    assert {got[i].keep_id for i in (0, 1, 2)} == {2} and got[2].group_size == 3  # the longest original of the empty ones
    assert {got[i].keep_id for i in (9, 10, 11)} == {9} and got[11].text_sha256 != got[9].text_sha256 or got[11].keep_id == 11
    repeated = spark.createDataFrame([(1, "a b"), (1, "a b"), (2, "ab"), (None, ""), (None, ""), (4, "z"), (4, "z"), (1, "q"), (3, "a b")], "doc_id long, text string")
    assert sorted(((r.doc_id, r.text) for r in exact_dedup.exact_dedup(repeated).collect()), key=str) == [(1, "a b"), (1, "q"), (4, "z"), (None, "")]
    kept = exact_dedup.exact_dedup(documents(spark))
    assert ids(kept) == [2, 3, 4, 5, 6, 7, 8, 9, 11, 12] and "kept" in kept.columns
    nulls = spark.createDataFrame([(None, "t"), (5, "t"), (None, None)], "doc_id long, text string")
    assert {r.keep_id for r in exact_dedup.duplicate_groups(nulls).filter("group_size = 2").collect()} == {5}
    assert exact_dedup.duplicate_groups(documents(spark).limit(0)).collect() == []


# near dedup


def components(texts, size, percent):
    sets = {}
    for i, t in texts.items():
        w = [x.lower() for x in words(t)]
        sets[i] = {tuple(w[j : j + size]) for j in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()
    inverted = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            inverted[x].append(i)
    common = Counter(p for found in inverted.values() for p in itertools.combinations(sorted(found), 2))
    up = {i: i for i in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for (a, b), n in common.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            a, b = top(a), top(b)
            up[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), top(i)) for i in sets}


def test_near_query(spark, data, texts):
    want = components(texts, 3, 85)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in minhash_dedup.query(spark, data).collect()} == want


@pytest.mark.parametrize("size,percent,seed", [(3, 85, 1), (5, 80, 2)])
def test_near_duplicates_of_edited_copies(spark, size, percent, seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(1000)]
    found = []
    for _ in range(20):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([1, 4, 9, 30, 120, 400]))]
        rate = rng.choice([0.0, 0.01, 0.03])
        found += [" ".join(rng.choice(vocabulary) if rng.random() < rate else w for w in base) for _ in range(12)]
    want = components(dict(enumerate(found)), size, percent)
    got = minhash_dedup.near_duplicates(documents(spark, found, extra=False), rules=minhash_dedup.Rules(shingle=size, percent=percent))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == want


def test_near_pairs_far_from_the_centre(spark):
    """Copies of one text, and pairs that each lack a tenth of it and share new words outside it."""
    rng = random.Random(7)
    fresh = lambda n: [f"v{rng.randrange(10**9)}" for _ in range(n)]
    found = []
    for _ in range(12):
        base = fresh(300)
        found += [" ".join([*base, *fresh(1)]) for _ in range(8)]
        added, lost = fresh(20), rng.randrange(30, 240)
        both = [*base[:lost], *base[lost + 30 :], *added]
        found += [" ".join([*both[:-k], *fresh(k)]) for k in (4, 6)]
        far = [*base[:120], *fresh(200)]
        found += [" ".join([*far, *fresh(k)]) for k in (3, 5)]
    for size, percent in ((3, 85), (5, 80)):
        want = components(dict(enumerate(found)), size, percent)
        got = minhash_dedup.near_duplicates(documents(spark, found, extra=False), rules=minhash_dedup.Rules(shingle=size, percent=percent))
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == want


def test_pairs_of_a_hot_document_in_parts(spark, monkeypatch):
    monkeypatch.setattr(minhash_dedup, "PAIRS_A_PART", 3)
    rng = random.Random(3)
    sets = {i: sorted(rng.sample(range(60), 30)) for i in range(25)}
    likely = spark.createDataFrame([(0, b, 30, 30) for b in range(1, 25)] + [(5, 9, 30, 30)], "a long, b long, n_a long, n_b long")
    got = {(r.a, r.b): r.common for r in minhash_dedup._compared(likely, spark.createDataFrame(list(sets.items()), "id long, hashes array<long>")).collect()}
    assert got == {(a, b): len(set(sets[a]) & set(sets[b])) for a, b in [(0, b) for b in range(1, 25)] + [(5, 9)]}


def test_pairs_of_a_star_that_share_much_outside_the_centre(spark):
    sets = {1: set(range(100)), 2: {*range(80), *range(200, 215)}, 3: {*range(80), *range(200, 215), 300}, 4: {*range(20, 100), *range(400, 415)}}
    stars = spark.createDataFrame([(1, b, 100, len(sets[b]), len(sets[1] & sets[b])) for b in (2, 3, 4)], "a long, b long, n_a long, n_b long, common int")
    labels = spark.createDataFrame([], "id long, component long")
    hashes = spark.createDataFrame([(i, sorted(s)) for i, s in sets.items()], "id long, hashes array<long>")
    got = minhash_dedup._across(stars, labels, hashes, minhash_dedup.Rules(shingle=3, percent=85))
    assert sorted(map(tuple, got.collect())) == [(2, 3)]


def test_near_duplicates_without_estimates(spark):
    rng = random.Random(9)
    base = [f"w{rng.randrange(300)}" for _ in range(400)]
    found = [" ".join(rng.choice(base) if rng.random() < rate else w for w in base) for rate in (0, 0.005, 0.01, 0.02) for _ in range(6)] + ["a b c", "a b c d", "a b c"]
    rules = minhash_dedup.exact(minhash_dedup.Rules())
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash_dedup.near_duplicates(documents(spark, found, extra=False), rules=rules).collect()}
    assert got == components(dict(enumerate(found)), 5, 80)


def test_near_duplicates_leave_one_table(spark, data):
    import os

    where = shared_dir(spark).removeprefix("file://").removeprefix("file:")
    before = set(os.listdir(where))
    found = minhash_dedup.near_duplicates(spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").limit(60))
    assert found.count() == 60 and [f.rsplit("-", 1)[0] for f in set(os.listdir(where)) - before] == ["near-result"]


def test_near_of_odd_rows(spark):
    got = {r.doc_id: r for r in minhash_dedup.near_duplicates(documents(spark)).collect()}
    assert [got[i].component_id for i in (0, 1, 2, 9, 10)] == [0, 1, 2, 9, 9] and got[0].n_shingles == 0
    assert ids(minhash_dedup.near_dedup(documents(spark))) == [i for i in range(len(ODD)) if i != 10]
    assert minhash_dedup.near_duplicates(documents(spark).limit(0)).collect() == []


# substring dedup


def removed(texts, window):
    seen, out = set(), {}
    for i in sorted(texts):
        w = words(texts[i])
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            key = tuple(w[s : s + window])
            if key in seen:
                gone[s : s + window] = [True] * window
            seen.add(key)
        out[i] = (len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone, strict=True) if not g)).hexdigest())
    return out


def test_substring_query(spark, data, texts):
    want = removed(texts, 20)
    assert {r.doc_id: tuple(r)[1:] for r in substring_dedup.query(spark, data).collect()} == want


@pytest.mark.parametrize("partitions", [1, 7])
def test_passages_across_shards(spark, partitions):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(30)]
    passages = [[rng.choice(vocabulary) for _ in range(rng.randrange(3, 40))] for _ in range(20)]
    texts = {i * 7 % 1009: " ".join(sum((rng.choice(passages) if rng.random() < 0.5 else [rng.choice(vocabulary) for _ in range(rng.randrange(12))] for _ in range(rng.randrange(9))), [])) for i in range(200)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(partitions)
    got = substring_dedup.substring_dedup(df, rules=substring_dedup.Passage(8, 3)).withColumn("h", F.sha2("kept_text", 256))
    assert {r.doc_id: (r.n_words, r.n_removed, r.h) for r in got.collect()} == removed(texts, 8)
    spans = got.filter("n_removed > 0").first()
    assert sum(s.end - s.start for s in spans.removed) == spans.n_removed


def packed_shard(texts, rules):
    batch = substring_dedup.pa.RecordBatch.from_pydict({"id": list(range(len(texts))), "text": texts})
    return substring_dedup.Shard(substring_dedup._parsed(batch), rules)


def test_the_automaton_decides(monkeypatch):
    """What the automaton finds is what is removed: without phrases nothing, without one phrase all but the windows that hold it."""
    rules = substring_dedup.Passage(6, 3)
    shard = packed_shard(["a b c d e f g h", "x a b c d e f g h y", "a b c d e f", "q r s t u v w"], rules)
    use, times, _ = substring_dedup._candidates(shard, None, 1)
    earlier = np.zeros(len(use), bool)

    def gone():
        return substring_dedup.removed_words(shard, use, times, earlier).tolist()

    assert gone() == [False] * 8 + [False, *[True] * 8, False] + [True] * 6 + [False] * 7
    full = substring_dedup.compiled

    def without(*phrases):
        def build(shard, passages, text, digits):
            left_out = {text[p * digits : (p + rules.part) * digits] for p in phrases}
            automaton = substring_dedup.ahocorasick.Automaton(substring_dedup.ahocorasick.STORE_INTS)
            for whole in full(shard, passages, text, digits):
                for phrase, number in whole.items():
                    if phrase not in left_out:
                        automaton.add_word(phrase, number)
            automaton.make_automaton()
            return [automaton]

        return build

    monkeypatch.setattr(substring_dedup, "compiled", without(*range(6)))
    assert not any(gone())
    monkeypatch.setattr(substring_dedup, "compiled", without(0))  # "a b c": windows without it are still found
    assert gone() == [False] * 8 + [False] * 2 + [True] * 7 + [False] + [False] * 6 + [False] * 7


@pytest.mark.parametrize("phrases", [1 << 20, 50])
@pytest.mark.parametrize("window", [1, 2, 3, 5, 7, 20])
def test_located_windows_are_equal_words(monkeypatch, window, phrases):
    """With one automaton as with many."""
    monkeypatch.setattr(substring_dedup, "PHRASES", phrases)
    rng = random.Random(window)
    rules = substring_dedup.Passage(window, 1)
    shard = packed_shard([" ".join(rng.choices("ab" if i % 2 else "abcdefgh", k=rng.randrange(60))) for i in range(40)], rules)
    starts = shard.start.tolist()
    text, digits = substring_dedup._letters(shard, shard.start)
    names = substring_dedup.locate(shard, substring_dedup.compiled(shard, shard.start, text, digits), text, digits).tolist()
    spelt = [tuple(shard.number[s : s + window].tolist()) for s in starts]
    assert min(names, default=0) >= 0 and len(set(zip(names, spelt, strict=True))) == len(set(names)) == len(set(spelt))


def test_word_hashes_tell_words_apart():
    found = [b"a", b"b", b"ab", b"ba", b"x" * 64, b"x" * 65, b"x" * 1000, b"\x00", b"\x00\x00"]
    hashes = substring_dedup._hashes(substring_dedup.pa.array(found, substring_dedup.pa.binary()))
    assert len(set(hashes.tolist())) == len(found)
    assert (substring_dedup._hashes(substring_dedup.pa.array(found[3:], substring_dedup.pa.binary())) == hashes[3:]).all()


def test_substring_ids_are_numbers(spark):
    with pytest.raises(TypeError):
        substring_dedup.substring_dedup(spark.createDataFrame([("a", "t")], "doc_id string, text string"))


def test_substring_of_odd_rows(spark):
    got = {r.doc_id: r for r in substring_dedup.substring_dedup(documents(spark)).collect()}
    assert len(got) == len(ODD) and got[0].n_words == 0 and got[6].n_removed == 29_999
    assert substring_dedup.substring_dedup(documents(spark).limit(0)).collect() == []


# byte pair encoding


def test_encoding_equals_the_library(spark, data, texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(bpe.tokenizer_path())
    rng = random.Random(2)
    every = [*texts.values(), *ODD, "<|endoftext|>a<|endoftext|> ", "don't I'LL we've\r\n\t  "] + ["".join(rng.choice("ab \n\té日🙂'st<|>1 0") for _ in range(rng.randrange(60))) for _ in range(200)]
    got = {r.doc_id: r for r in bpe.encode_decode(documents(spark, every), bpe.tokenizer_path()).collect()}
    for i, x in enumerate(every):
        want = t.encode(x or "", add_special_tokens=False).ids
        assert got[i].ids == want and got[i].decoded == t.decode(want, skip_special_tokens=False)


def test_long_words_equal_the_library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(bpe.tokenizer_path())
    rng = random.Random(8)
    encoder = bpe.Encoder(bpe.Vocabulary(open(bpe.tokenizer_path(), encoding="utf-8").read()))
    parts = [list("etaoinshrdlu"), ["the", "ing", "tion", "er", "ation"], [c * n for c in "=-_*#" for n in (1, 2, 3, 31, 64, 129, 200)], list("éñßδ日本"), list("ÃÂ")]
    found = ["".join(rng.choice(p) for _ in range(n)) for p in parts for n in (300, 900, 2500) for _ in range(3)]
    for x in [*found, "a" * 70_000, " ".join(found[:4])]:
        assert encoder.encode([x])[0].tolist() == t.encode(x, add_special_tokens=False).ids


def test_decoding_of_ids(spark):
    df = spark.createDataFrame([([15496, 995],), (None,), ([],), ([50256],), ([222],)], "ids array<int>")
    assert [r.decoded for r in bpe.decode_ids(df, bpe.tokenizer_path()).collect()] == ["Hello world", "", "", "<|endoftext|>", "�"]
    assert bpe.encode_decode(documents(spark).limit(0), bpe.tokenizer_path()).collect() == []


# mixing


def slots_are_fair(u, blocks, span, got):
    """Every block in the window of its exact weight, a slot for one block only, all sources whole but the most lasting one."""
    total = sum(u)
    for s, block, slot in got:
        assert block * total // u[s] <= slot < -(-(block + 1) * total // u[s])
    assert len({slot for _, _, slot in got}) == len(got) == len({(s, b) for s, b, _ in got})
    lasting = sorted(range(len(u)), key=lambda i: -(-blocks[i] * total // u[i]))
    assert {(s, b) for s, b, _ in got} >= {(s, b) for s in lasting[:-1] for b in range(blocks[s])}


@pytest.mark.parametrize("u,blocks,span", [([1, 1, 1], [40, 30, 30], 4), ([1], [5], 4), ([7, 1, 1, 1], [90, 10, 12, 9], 4), ([11, 40, 3, 3, 17, 29], [60, 200, 11, 40, 90, 140], 8), ([5, 17, 2, 29, 1, 1], [70, 80, 30, 90, 8, 3], 1024)])
def test_blocks_keep_their_windows(spark, u, blocks, span):
    rows = [(f"s{i}", i, x, sum(u), n) for i, (x, n) in enumerate(zip(u, blocks, strict=True))]
    frame = mixing._frame(spark.createDataFrame(rows, "source string, s int, u long, total long, blocks long"), span)
    got = [tuple(r) for r in mixing.plan(mixing._borders(frame, frame.first().ranges)).select("s", "block", "slot").collect()]
    slots_are_fair(u, blocks, span, got)
    # lag below one block over the slots that all sources fill
    full = min(n * sum(u) // x for n, x in zip(blocks, u, strict=True))
    done, order = [0] * len(u), {slot: s for s, _, slot in got}
    for t in range(min(full, len(order))):
        done[order[t]] += 1
        assert all(abs(d * sum(u) - (t + 1) * x) < sum(u) for d, x in zip(done, u, strict=True))


def test_units_of_weights(spark):
    rows = [("a", 1.0), ("b", 2.0), (None, 4.0), ("z", 0.0), ("n", None)]
    got = {r.source: r for r in mixing.units(spark.createDataFrame(rows, "source string, weight double")).collect()}
    assert (got["a"].u, got["b"].u, got[None].u, got["z"].u, got["z"].s, got["n"].s) == (1, 2, 4, 0, None, None) and got["a"].total == 7
    got = mixing.units(spark.createDataFrame([(str(i), 0.3) for i in range(3)], "source string, weight double")).collect()
    assert len({r.u for r in got}) == 1 and sorted(r.s for r in got) == [0, 1, 2]
    for tiny in (1e-12, 1.0):
        got = {r.source: r.u for r in mixing.units(spark.createDataFrame([("big", tiny * 2.0**40), ("tiny", tiny)], "source string, weight double")).collect()}
        assert got["tiny"] * mixing.SMALLEST == mixing.UNITS and abs(got["big"] - mixing.UNITS) < 2


def test_mixing_query_against_brute_force(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    draw = F.pmod(F.xxhash64("doc_id", F.lit(mixing.SEED)), F.lit(1 << 31))
    per = defaultdict(list)
    for r in docs.select("doc_id", "source", draw.alias("d")).collect():
        per[r.source].append((r.d, r.doc_id))
    got = {r.doc_id: r for r in mixing.query(spark, data).collect()}
    assert len(got) == docs.count()
    names = sorted(per)
    weight = [len(per[n]) ** 0.5 for n in names]
    u = [round(w / sum(weight) * mixing.UNITS) for w in weight]
    slots = []
    for s, n in enumerate(names):
        for i, (_, x) in enumerate(sorted(per[n])):
            assert (got[x].mix_block, got[x].mix_offset) == divmod(i, mixing.BLOCK_DOCS)
        slots += sorted({(s, got[x].mix_block, got[x].mix_slot) for _, x in per[n]})
    blocks = [-(-len(per[n]) // mixing.BLOCK_DOCS) for n in names]
    lasting = max(range(len(u)), key=lambda i: -(-blocks[i] * sum(u) // u[i]))
    planned = max(slot for s, _, slot in slots if s != lasting)
    slots_are_fair(u, blocks, mixing.RANGE_SLOTS, [x for x in slots if x[0] != lasting or x[2] <= planned])


def test_schedule_places_every_row_once(spark):
    df = spark.createDataFrame([(i, None if i % 7 == 0 else "hot" if i % 2 else f"s{i % 5}") for i in range(3000)], "doc_id long, source string")
    weights = spark.createDataFrame([("hot", 1.0), ("s0", 3.0), (None, 1.0), ("s2", 0.0), ("s4", 2.0)], "source string, weight double")
    got = mixing.schedule(df, weights, block_docs=4, range_slots=20).toPandas()
    outside = got[got.mix_slot.isna()]
    assert len(got) == 3000 and set(outside.source) == {"s1", "s2", "s3"} & set(df.toPandas().source)
    inside = got[got.mix_slot.notna()]
    assert inside.groupby(["mix_slot", "mix_offset"]).size().max() == 1
    assert inside.groupby("mix_slot").source.nunique(dropna=False).max() == 1
    for _, g in got.groupby(got.source.fillna("none")):
        assert sorted(g.mix_block * 4 + g.mix_offset) == list(range(len(g)))


def test_mixing_keeps_rows_and_columns(spark):
    docs = documents(spark)
    out = mixing.mix(docs.union(docs.limit(2)))
    assert out.columns == docs.columns and out.count() == len(ODD) + 2
    assert mixing.mix(docs.limit(0)).collect() == []


# secrets


def base_spans(t):
    t, out = t or "", []
    for m in re.finditer(secrets_scan.ASSIGN, t):
        if len(m[2]) >= 12:
            out.append((m.start(), 0, m.end()))
    for k, pattern, least in ((1, "AKIA[A-Z0-9]+", 18), (2, "[0-9a-f]+", 16)):
        out += [(m.start(), k, m.end()) for m in re.finditer(pattern, t) if len(m[0]) >= least]
    return ",".join(f"{secrets_scan.KINDS[k]}:{a}:{b}" for a, k, b in sorted(out))


def test_secret_query(spark, data, texts):
    for r in secrets_scan.query(spark, data).collect():
        assert r.base_sha256 == hashlib.sha256(base_spans(texts[r.doc_id]).encode()).hexdigest()


def test_all_secret_spans_over_the_whole_table(spark, data, texts):
    """The spans column against brute force: base spans, and tokens whose value fewer than three sources have and no base span overlaps."""
    source = {r.doc_id: r.source for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    owners, base_values, general = defaultdict(set), set(), defaultdict(list)
    for i, t in texts.items():
        t = t or ""
        for m in re.finditer(secrets_scan.ASSIGN, t):
            if len(m[2]) >= 12:
                owners[m[2]].add(source[i]), base_values.add(m[2])
        for pattern, least in (("AKIA[A-Z0-9]+", 18), ("[0-9a-f]+", 16)):
            for m in re.finditer(pattern, t):
                if len(m[0]) >= least:
                    owners[m[0]].add(source[i]), base_values.add(m[0])
        for m in re.finditer("[A-Za-z0-9+/_=-]+", t):
            if len(m[0]) >= 20 and all(re.search(c, m[0]) for c in ("[A-Z]", "[a-z]", "[0-9]")):
                owners[m[0]].add(source[i]), general[i].append(m)
    n_added = 0
    for r in secrets_scan.query(spark, data).collect():
        spans = [(int(a), secrets_scan.KINDS.index(k), int(b)) for k, a, b in (x.split(":") for x in base_spans(texts[r.doc_id]).split(",") if x)]
        more = [(m.start(), 3, m.end()) for m in general[r.doc_id] if len(owners[m[0]]) < 3 and not any(a < m.end() and m.start() < b for a, _, b in spans)]
        n_added += len(more)
        assert r.spans == ",".join(f"{secrets_scan.KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans + more))
    repeated = spark.createDataFrame([(1, "token=abcdefghijkl", "s")] * 3, "doc_id long, text string, source string")
    assert [len(r.base) for r in secrets_scan.scan(repeated).collect()] == [1, 1, 1]


def test_secret_spans_of_noise(spark):
    rng = random.Random(5)
    parts = ["token", "=", ": ", "'", '"', " ", "secret", "AKIA", "A9Z", "abcdef012345", "ff", "Zz9", "é🙂", "\u0001", "\u0002", "\n", "API_KEY", "Apikey", "Passwd"]
    found = ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(300)] + ODD
    got = secrets_scan.scan(documents(spark, found)).select("doc_id", secrets_scan._joined(F.col("base")).alias("s")).collect()
    assert len(got) == len(found) and all(r.s == base_spans(found[r.doc_id]) for r in got)


def test_ownership_decides_on_added_spans(spark):
    own, copied = "Xk29fLq8ZmB4tR7wPd31", "Ab12Cd34Ef56Gh78Ij90"
    rows = [(1, f"see {own} here", "a")] + [(10 + i, f"example {copied} .", f"o{i}") for i in range(4)]
    got = {r.doc_id: r for r in secrets_scan.scan(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert [(s.start, s.end) for s in got[1].added] == [(4, 24)] and got[1].n_live == 1
    assert got[10].added == [] and got[10].n_example == 1


def test_secrets_of_copies_and_of_every_owner_count(spark):
    value = lambda n: f"Xk29fLq8ZmB4tR7wPd3{n}"
    rows = [(i, f"see {value(0)} here", "a") for i in range(100)]
    rows += [(1000 * n + o, f"see {value(n)} here", f"o{o}") for n in range(1, 6) for o in range(n)]
    for r in secrets_scan.scan(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect():
        owners = max(1, r.doc_id // 1000)
        assert ([(s.start, s.end) for s in r.added], r.n_live, r.n_example) == (([(4, 24)], 1, 0) if owners < 3 else ([], 0, 1))


# web pages


def test_cuts_are_minimal():
    rng = random.Random(1)
    for _ in range(300):
        n = rng.randrange(1, 8)
        c = [rng.choice([-1, 1]) * rng.randrange(6) / 2 for _ in range(n)]
        e = [(a, b, rng.randrange(1, 5) / 2) for a, b in ((rng.randrange(n), rng.randrange(n)) for _ in range(rng.randrange(10))) if a != b]

        def cost(labels, c=c, e=e):
            return sum(abs(x) for x, k in zip(c, labels, strict=True) if (x > 0) != k and x) + sum(w for a, b, w in e if labels[a] != labels[b])

        assert cost(html_extract.min_cut(c, e)) == pytest.approx(min(map(cost, itertools.product([False, True], repeat=n))))


PAGE = """<!DOCTYPE html><html><head><title>t</title><script>var x = "</p>";</script></head><body class="has-sidebar"><header><h1>Site</h1><a href=x>Home</a></header>
<div class="cookie-notice">We use cookies</div><main><article><header><h1>T &amp; U</h1></header><p>One <b>two</b>\n three.<p>Four<div class="ad">Buy!</div>
<form><label>mail</label><input></form><blockquote>Q</blockquote><ul><li>a<li>b</ul></article><section id="comments"><h2>Comments</h2><p>nice post it is</section></main><aside>rel</aside><footer>c</footer></body></html>"""


def test_page_parts(spark):
    df = spark.createDataFrame([(1, PAGE), (2, None), (3, ""), (4, "<p>"), (5, "x" * 100_000), (6, "<a <b <!-- <p class='"), (7, "<article>" + "<p>w" * 3000)], "page_id long, html string").withColumn("text", F.lit("clash"))
    got = {r.page_id: r.text for r in html_extract.extract_text(df).collect()}
    assert got[1] == "T & U\nOne two three.\nFour\nQ\na\nb"
    assert got[2] == got[3] == got[4] == "" and got[7].count("\n") == 2999
    assert html_extract.extract_text(df.limit(0)).collect() == []


#: A classifier for tests: words count for a block, links and headings against it.
WEIGHTS = np.array([-1.0, 1.0, -6.0, 1.0, 0, -2.0, 0, 0])


def own_sign(page):
    blocks = html_extract.blocks_of(page)
    return [x > 0 for x in html_extract.graph(blocks, WEIGHTS)[0]]


def test_the_cut_decides_in_named_containers():
    text = "<p>One two three four five six seven eight nine ten.</p>"
    # a link among paragraphs: its own score says boilerplate, its neighbours keep it
    page = f"<article>{text}<p><a href=x>more</a></p>{text}</article>"
    assert own_sign(page) == [True, False, True] and html_extract.extract(page, WEIGHTS).count("more") == 1
    # a menu without a name inside the article: the whole list costs more than its edges
    page = f"<article>{text}<ul>" + "<li><a href=x>go</a>" * 12 + f"</ul>{text}</article>"
    assert "go" not in html_extract.extract(page, WEIGHTS) and html_extract.extract(page, WEIGHTS).count("ten.") == 2
    # other weights, other text: the classifier's costs are the capacities
    assert html_extract.extract(page, -WEIGHTS) != html_extract.extract(page, WEIGHTS)


def test_pages_without_containers():
    text = "<p>One two three four five six seven eight nine ten.</p>"
    links = "<ul>" + "<li><a href=x>go</a>" * 6 + "</ul>"
    assert html_extract.extract(links + text * 3 + links, WEIGHTS) == "\n".join(["One two three four five six seven eight nine ten."] * 3)
    assert html_extract.extract(text, np.zeros(8)) == "" and html_extract.extract("no tags & no blocks at all, only words.", WEIGHTS) == "no tags & no blocks at all, only words."


def test_reduced_cuts_equal_full_ones():
    rng = random.Random(3)
    for _ in range(100):
        n = rng.randrange(1, 12)
        c = [rng.randrange(-40, 41) / 10 + 0.001 * rng.random() for _ in range(n)]
        e = [(i, i + 1, 0.8) for i in range(n - 1)] + [(i, i + 2, 0.6) for i in range(n - 2)]
        cost = lambda labels: sum(abs(x) for x, k in zip(c, labels, strict=True) if (x > 0) != k) + sum(w for a, b, w in e if labels[a] != labels[b])
        assert cost(html_extract.min_cut(c, e)) == pytest.approx(cost(html_extract._max_flow(c, e)), abs=0.02)


def test_text_of_inline_elements_and_unclosed_ones_stays():
    get = lambda page: html_extract.extract(page, WEIGHTS)
    assert get("<article><p>one<select><option>x<p>two three four</article><p>end").startswith("one\ntwo three four")
    assert get("<article><p>a<script src=/a/>var leak=1;</script> <button>b</button> <textarea>c</textarea> <math>d</math> <noscript>e</noscript> <svg><path d=1/>f</svg> <canvas>g</canvas></p></article>") == "a b c d e f g"
    assert get("<article><p>1 < 2 & 3 > 2 <!-- <b>x</b> --><!bogus>y<wbr>z</article>") == "1 < 2 & 3 > 2 yz"
    assert get('<article><p title="a > b" class=\'c>d\'>one</p><p a="unclosed>two</p><p>three</article>') == "one\ntwo\nthree"
    assert get("<article><title>lost<p>kept</p><!-- open<p>also</p></article>") == "kept\nalso"


@pytest.mark.parametrize("page", ['<a "x ' * 30_000, "<a " * 70_000, "<div>x" * 30_000, "<b><p>x</p>" * 30_000, '<a b=">" ' * 30_000, "<!-- x" * 60_000, "<script>x" * 60_000, "<" * 300_000, "<p>" + "<li>x" * 60_000, "<select><option>x" * 30_000, "</b>" * 150_000])
def test_hostile_pages_take_linear_time(page):
    import time

    began = time.process_time()
    html_extract.extract(page, WEIGHTS)
    assert time.process_time() - began < 10


KEPT_TAGS = [
    '<p title="some hidden gems">', '<p data-hidden="x">', '<section data-id="share">', '<p data-class="ad">', "<p title='display:none'>", '<p data-role=menu>', '<p title="aria-hidden=true">', '<p aria-hidden="false">', '<p style="display:block">',
    '<p class="x" data-x="footer">', '<div onclick="share(1)">', '<p alt="nav" id=lead>', '<p style="x-display:nonesuch">', '<p title="class=comment">', "<p title='id=\"sidebar\"'>", '<p xclass="ad">', '<p aria-role="menu">', '<p lang=en title=hidden>', '<p id="a" id="ad">', '<p data-style="display:none">', '<p title="a > b hidden">',
]
LOST_TAGS = ["<p hidden>", "<p HIDDEN=''>", '<p style="color:red; DISPLAY : none">', "<p aria-hidden=true>", "<div class='x share'>", '<section id="comments">', "<p CLASS=ad>", "<div role = 'menu'>", '<p a="b"class="ad">', "<p class='&#97;d'>"]


@pytest.mark.parametrize("tag", KEPT_TAGS + LOST_TAGS)
def test_only_exact_attributes_hide_text(spark, tag):
    name = re.match("<([a-z]+)", tag)[1]
    page = f"<article><h1>Title of it</h1><p>First words of a text.</p>{tag}The words in question here.</{name}><p>Last words of a text.</p></article>"
    lost = {b.text for b in html_extract.blocks_of(page) if b.state < 0}
    assert ("The words in question here." in lost) == (tag in LOST_TAGS)


def test_page_query(spark, data):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{data}/pages.parquet").collect()}
    import html

    for r in html_extract.query(spark, data).collect():
        inside = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"<p>|</p>|</h1>", inside)]
        assert r.text == "\n".join(filter(None, parts)) and r.n_chars == len(r.text)


def test_whole_table_with_more_boilerplate_keeps_its_texts(spark, data):
    """Menus, notices, sidebars, forms and readers' comments around and inside the articles of all pages change no text."""
    pages = spark.read.parquet(f"{data}/pages.parquet").select("page_id", "html")
    before = """<header class="site-header"><p>Site name and slogan of the day, for all readers.</p></header><div id="cookie-notice"><p>We use cookies. By going on you accept them all, and the partners' too.</p><button>OK</button></div>
    <aside class="sidebar"><h3>Most read</h3><ul><li><a href="/a">One more story</a></li><li><a href="/b">And another story</a></li></ul></aside>"""
    inside = """<form><label>Mail</label><input name=m><p>Subscribe to our newsletter for news every morning.</p></form><div class='ad'><p>Buy now, and save a lot of money today.</p></div>"""
    after = """<section id="comments"><h2>Comments</h2><article class="comment"><p>I liked the article very much, thanks for writing all of it down.</p></article><article class="comment reply"><p>So did I, and more than once.</p></article></section>
    <div class="related"><p><a href="/c">Related: a further story</a></p></div><noscript><p hidden>Turn on scripts.</p></noscript>"""
    more = pages.withColumn("html", F.replace(F.replace("html", F.lit("<article>"), F.lit(before + "<article>")), F.lit("</article>"), F.lit(inside + "</article>" + after)))
    plain = {r.page_id: r.text for r in html_extract.extract_text(pages).collect()}
    full = {r.page_id: r.text for r in html_extract.extract_text(more).collect()}
    assert len(plain) == pages.count() and {i for i in plain if plain[i] != full[i]} == set()


# languages


def test_language_of_held_out_rows(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "lang")
    got = language_id.query(spark, data).join(docs, "doc_id").filter("held_out AND lang IS NOT NULL").collect()
    assert np.mean([r.lang == r.lang_pred for r in got]) > 0.9 and all(0 <= r.score <= 1 for r in got)


def test_summed_tables_give_the_same_responses():
    net = language_id.ByteNet(["a", "b"], language_id.Settings())
    x = np.random.default_rng(0).integers(0, 256, (50, 128)).astype(np.uint8)
    peak, _ = net._peaks(x)
    assert np.allclose(language_id._softmax(np.maximum(peak + net.bias, 0) @ net.out + net.out_bias), net.probabilities(x), atol=1e-4)


def test_rare_languages_are_learnt(spark):
    rng = random.Random(4)
    say = lambda letters: " ".join("".join(rng.choice(letters) for _ in range(6)) for _ in range(40))
    rows = [(i, say("abcdef"), "common") for i in range(1500)] + [(5000 + i, say("uvwxyz"), "rare") for i in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    net = language_id.learn(df, settings=language_id.Settings(sample_docs=60))
    assert net.labels == ["common", "rare"] and net.predict([say("uvwxyz"), say("abcdef")])[0] == ["rare", "common"]
    assert language_id._sample(df, "lang", 60).count() <= 120 and language_id._sample(df, "lang", 60).filter("lang = 'rare'").count() == 4


def test_letters_are_letters():
    net = language_id.ByteNet(["a"], language_id.Settings())
    assert net.predict(["½ ² ① 12 _", "٣", "é", "日", "a1"])[0] == ["und", "und", "a", "a", "a"]


def test_language_of_odd_rows(spark):
    docs = documents(spark)
    net = language_id.learn(docs, settings=language_id.Settings(epochs=1))
    got = {r.doc_id: r for r in language_id.identify(docs, net).collect()}
    assert [got[i].lang_pred for i in (0, 1, 2, 8)] == ["und"] * 4 and len(got) == len(ODD)
    assert language_id.learn(docs.limit(0)).predict(["abc", None]) == (["und", "und"], [0.0, 0.0])


# chats


def test_chat_query(spark, data):
    assert oracle.compare(chat_format.query(spark, data), oracle.connect(data), chat_format.ORACLE) == ""


def test_tool_calls_are_linked_and_ordered(spark):
    call = {"tool_calls": [{"id": "b", "name": "f", "arguments": {"x": {"$ref": "a"}}}, {"id": "c", "name": "f", "arguments": {"x": "no"}}]}
    rows = [
        (1, 0, "user", "hi"), (1, 1, "assistant", json.dumps(call)), (1, 2, "tool", json.dumps({"tool_call_id": "b", "content": "2"})),
        (1, 3, "assistant", json.dumps({"content": "é", "tool_calls": [{"id": "a", "name": "f", "arguments": '{"x": 1}'}]})), (1, 4, "tool", json.dumps({"tool_call_id": "a", "content": {"z": 1, "b": 2}})),
        (1, 5, "tool", json.dumps({"tool_call_id": "zz"})), (1, 6, "assistant", "{bad"), (None, None, None, None), (2, 0, "tool", json.dumps({"tool_call_id": "a"})),
    ]
    schema = {"f": {"type": "object", "properties": {"x": {"type": "integer"}}, "required": ["x"], "additionalProperties": False}}
    got = {(r.conv_id, r.turn): r for r in chat_format.format_chat(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), schema).collect()}
    assert (got[1, 1].n_calls, got[1, 1].n_valid, got[1, 1].n_answered) == (2, 1, 1)
    assert got[1, 3].message == '{"content":"é","role":"assistant","tool_calls":[{"arguments":{"x":1},"id":"a","name":"f"}]}'
    place = {k: (r.seq, r.depth, r.result) for k, r in got.items() if k[0] == 1}
    assert place[1, 3] < place[1, 4] and place[1, 4] < place[1, 2]  # the call of b waits for a's result
    assert not got[1, 5].linked and not got[2, 0].linked and got[1, 4].linked
    assert got[1, 6].message == '{"content":"{bad","role":"assistant"}' and (None, None) in got


def call_text(*calls):
    return json.dumps({"tool_calls": [{"id": i, "name": "f", "arguments": {"x": [{"$ref": r} for r in refs]}} for i, refs in calls]})


def chat_rows(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_long_chains_and_cycles(spark):
    chain = call_text(*[(f"c{i:03d}", [f"c{i - 1:03d}"] if i else []) for i in range(200)])
    rows = [(1, 0, "assistant", chain), (2, 0, "assistant", call_text(("a", ["b"]))), (2, 1, "assistant", call_text(("b", ["a"]), ("c", ["b"]), ("d", ["d"]), ("e", [])))]
    calls = chat_format._order(chat_rows(spark, []).select("conv_id", "turn").crossJoin(spark.createDataFrame([], "call_id string, refs array<string>")))
    assert calls.collect() == []
    got = {(r.conv_id, r.turn): r for r in chat_format.format_chat(chat_rows(spark, rows)).collect()}
    assert (got[1, 0].n_calls, got[1, 0].n_cyclic) == (200, 0) and (got[2, 0].n_cyclic, got[2, 1].n_cyclic) == (1, 3)
    results = [(1, 1 + i, "tool", json.dumps({"tool_call_id": f"c{i:03d}"})) for i in range(200)]
    placed = chat_format.format_chat(chat_rows(spark, rows[:1] + results)).filter("result = 1").collect()
    assert {r.turn - 1: (r.seq, r.depth) for r in placed} == {i: (0, i) for i in range(200)}
    assert chat_format.format_chat(chat_rows(spark, [])).collect() == []


def test_rounds_order_as_one_task_does(spark):
    rng = random.Random(6)
    rows = []
    for conv in range(12):
        names = [f"k{i}" for i in range(rng.randrange(2, 12))]
        rows += [(conv, t, "assistant", call_text(*[(n, rng.sample(names, rng.randrange(3)) if rng.random() < 0.5 else []) for n in rng.sample(names, rng.randrange(1, len(names) + 1))])) for t in range(3)]
        rows += [(conv, 3 + i, "tool", json.dumps({"tool_call_id": n})) for i, n in enumerate(names)]
    found = [sorted(map(tuple, chat_format.format_chat(chat_rows(spark, rows), local_calls=n).collect())) for n in (0, 10_000)]
    assert found[0] == found[1]


DEEP = "[" * 3000 + "]" * 3000
BAD = ['{"content": "\\ud800", "tool_calls": []}', '{"tool_calls": [{"id": "a", "name": "f", "arguments": ' + DEEP + "}]}", '{"tool_calls": [{"id": "a", "name": "f", "arguments": {"x": 1e999}}]}', '{"tool_calls": [{"id": NaN}]}', "{" * 100_000, '{"tool_calls": ' + "9" * 5000 + "}"]


def test_control_characters_have_one_form(spark):
    odd = [chr(i) for i in [*range(1, 32), 34, 47, 92, 127, 0x2028, 0xE9, 0x1F642]]
    texts = [f"a{c}b" for c in odd] + [f"{{x{c}" for c in odd] + ["{\\u001f \\\\u001f"]
    got = {r.turn: r.message for r in chat_format.format_chat(chat_rows(spark, [(1, i, "assistant", t) for i, t in enumerate(texts)])).collect()}
    for i, t in enumerate(texts):
        assert json.loads(got[i]) == {"content": t, "role": "assistant"}
        assert got[i] == chat_format.canonical({"content": t, "role": "assistant"})


def test_odd_texts_of_chats(spark):
    schema = {"f": {"properties": {"x": {"type": "integer"}}}}
    fine = ['{"tool_calls": [{"id": "a", "name": "f", "arguments": "' + "[" * 100_000 + '"}]}', '{"tool_calls": [{"id": "b", "name": "f", "arguments": {"x": ' + "9" * 400 + "}}]}", '{"tool_calls": [{"id": 7, "name": "f", "arguments": {"x": 2.0}}]}']
    rows = [(1, i, "assistant", t) for i, t in enumerate(BAD + fine)] + [(1, 50, "tool", '{"tool_call_id": 7, "content": "\\ud800"}'), (1, 51, "tool", '{"tool_call_id": 7}'), (1, 52, "assistant", "x" * 300_000), (1, 53, None, None)]
    df = chat_rows(spark, rows).withColumns({c: F.lit("clash") for c in ("seq", "calls", "message", "linked")})
    got = {r.turn: r for r in chat_format.format_chat(df, schema).collect()}
    assert len(got) == len(rows)
    for i, t in enumerate(BAD):
        assert got[i].message == json.dumps({"content": t, "role": "assistant"}, sort_keys=True, separators=(",", ":")) and got[i].n_calls == 0
    assert [got[len(BAD) + i].n_valid for i in range(3)] == [0, 1, 1]
    assert json.loads(got[len(BAD)].message)["tool_calls"][0]["arguments"] == "[" * 100_000
    assert got[50].result == 0 and got[51].linked and got[52].n_calls == 0


def test_tool_calls_over_the_whole_table(spark, data):
    """Every assistant turn of the given table becomes a call, every second one answered by the next user turn, against brute force."""
    schemas = {"tool0": {"type": "object", "properties": {"n": {"type": "integer", "maximum": 40}}, "required": ["n"]}, "tool1": {"type": "object", "required": ["q"]}}
    made, texts = [], spark.read.parquet(f"{data[:-5]}0.01/conversations.parquet").collect()
    for r in texts:
        n = len(r.text or "")
        if r.role == "assistant":
            refs = [{"$ref": f"c{r.turn - d}"} for d in (2, -2) if (n + d) % 3 == 0]
            made.append((r.conv_id, r.turn, r.role, json.dumps({"content": r.text, "tool_calls": [{"id": f"c{r.turn}", "name": f"tool{n % 3}", "arguments": {"n": n, "refs": refs}}]})))
        elif r.role == "user" and n % 2:
            made.append((r.conv_id, r.turn, "tool", json.dumps({"tool_call_id": f"c{r.turn - 1}", "content": r.text})))
        else:
            made.append(tuple(r))
    made = [m for m in made if m[1] is not None]
    calls = {(c, json.loads(t)["tool_calls"][0]["id"]): (turn, json.loads(t)["tool_calls"][0]) for c, turn, role, t in made if role == "assistant"}
    answered = {(c, json.loads(t)["tool_call_id"]) for c, _, role, t in made if role == "tool"}
    assert len(calls) > 50 and len(answered & set(calls)) > 10

    def place(key, path=()):
        """(seq, depth) of a call, or None on or behind a cycle."""
        if key in path:
            return None
        best = (calls[key][0], 0)
        for ref in calls[key][1]["arguments"]["refs"]:
            if (key[0], ref["$ref"]) in calls:
                of = place((key[0], ref["$ref"]), (*path, key))
                if of is None:
                    return None
                best = max(best, (of[0], of[1] + 1))
        return best

    got = {(r.conv_id, r.turn): r for r in chat_format.format_chat(chat_rows(spark, made), schemas).collect()}
    assert len(got) == len(made)
    for c, turn, role, t in made:
        r, body = got[c, turn], json.loads(t) if role in ("assistant", "tool") else None
        key = (c, body["tool_call_id"] if role == "tool" else f"c{turn}") if body else None
        at = place(key) if key in calls else None
        if role == "assistant":
            n = calls[key][1]["arguments"]["n"]
            name = calls[key][1]["name"]
            assert (r.n_calls, r.n_valid, r.n_answered, r.n_cyclic) == (1, int(name == "tool0" and n <= 40), int(key in answered), int(at is None))
            assert r.message == chat_format.canonical({"content": body["content"], "role": role, "tool_calls": [{k: calls[key][1][k] for k in ("arguments", "id", "name")}]})
        if role == "tool":
            assert r.linked == (key in calls) and r.result == 1
        if role != "tool" or key in calls:
            want = at or ((calls[key][0], 0) if key in calls else (turn, 0))
            assert (r.seq, r.depth) == want


# pipeline


def test_pipeline_against_brute_force(spark, data, texts):
    def passes(t):
        w = words(t)
        if len(w) < 20:
            return False
        spans = np.array(quality_rules.repeats(np.unique(np.array(w, dtype=object).astype("S"), return_inverse=True)[1].astype(np.int64), np.zeros(len(w), np.int64)))
        at = np.arange(len(w))
        share = lambda least, cap: (np.maximum.accumulate(np.where(spans >= least, at + np.minimum(spans, cap), 0)) > at).sum()
        return 100 * share(8, 8) <= 30 * len(w) and 100 * share(4, len(w)) <= 50 * len(w) and 100 * spans.max() <= 40 * len(w)

    left = {i: t for i, t in texts.items() if passes(t)}
    groups = defaultdict(list)
    for i, t in left.items():
        groups[re.sub(r"[\x20\x09-\x0D]", "", t)].append((-len(t), i))
    left = {i: texts[i] for i in (min(g)[1] for g in groups.values())}
    left = {i for i, (_, c) in components(left, 5, 80).items() if c == i}
    got = corpus_pipeline.run(spark, data)
    assert set(ids(got)) == left and got.count() == len(left)
    encoder = bpe.Encoder(bpe.Vocabulary(open(bpe.tokenizer_path(), encoding="utf-8").read()))
    for r in got.collect():
        assert r.ids == encoder.encode([texts[r.doc_id]])[0].tolist() and r.n_tokens == len(r.ids)


def test_pipeline_returns_places_and_decodes(spark, data, texts):
    got = corpus_pipeline.run(spark, data).select("doc_id", "source", "mix_slot", "mix_offset", "decoded_sha256").collect()
    slots = defaultdict(list)
    for r in got:
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
        slots[r.mix_slot].append(r)
    for rows in slots.values():
        assert len({r.source for r in rows}) == 1 and sorted(r.mix_offset for r in rows) == list(range(len(rows)))
    # in a source, blocks are full but for the last
    for source in {r.source for r in got}:
        sizes = [len(rows) for _, rows in sorted(slots.items()) if rows[0].source == source]
        assert all(n == mixing.BLOCK_DOCS for n in sizes[:-1])


def test_a_second_run_leaves_the_first_ones_rows(spark, data):
    first = corpus_pipeline.run(spark, data)
    corpus_pipeline.run(spark, data)
    again = {(r.doc_id, r.source): (r.mix_slot, r.mix_offset) for r in first.collect()}
    docs = spark.read.parquet(f"{data}/documents.parquet").join(first.select("doc_id", "source"), ["doc_id", "source"], "left_semi")
    corpus_pipeline.PLACES.clear()
    alone = corpus_pipeline.encoded(spark, docs, data)
    assert {(r.doc_id, r.source): (r.mix_slot, r.mix_offset) for r in alone.collect()} == again


def test_stages_keep_the_columns(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").limit(40)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, data).columns == docs.columns


def test_registered():
    assert {re.match(r"op(\d+)_", n)[1] for n in queries.QUERIES} == {str(i) for i in range(1, 14)}
    assert set(queries.ORACLES) <= set(queries.QUERIES)
