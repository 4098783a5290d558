"""The corpus operators against plain versions of themselves, on odd rows and on the small tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from math import log10

import numpy as np
import pytest
import xxhash
from check_oracle import compare, connect
from pyspark.sql import functions as F

import corpus_pipeline
from ouvidoria.llm import exact_dedup, language_id, mixing, near_copies, packing, phrases, quality, queries, simhash, suffix_tree, topk, toxicity
from ouvidoria.llm.components import roots

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, digest int, fp string"


def words_of(text):
    return (text or "").encode().split()


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows and extra columns with clashing names."""
    rng = random.Random(3)
    base = [" ".join(rng.choice("alpha beta gamma delta eps zeta eta theta".split()) + str(rng.randrange(40)) for _ in range(120)) for _ in range(6)]
    texts = [None, "", "  \t\n", "a", "a", "A", base[0], base[0].replace(" ", "\n", 3), base[0] + " tail", base[1][:300] + " " + base[0],
             base[2] * 40, base[3].upper(), "same " * 300, "same " * 200, "é ñ ü <|endoftext|> 12", base[4], base[5], base[4] + "!"]
    rows = [(i, t, ("en", "de", None)[i % 3], ("s1", "s0", None, "s2")[i % 4], len(t or ""), "x", 1, "y") for i, t in enumerate(texts)]
    rows += [rows[6], rows[6], (None, base[1], None, "s0", 1, None, None, None), (6, "other text of a repeated id", "en", "s1", 1, "", 0, "")]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(
        [(i, i % 2, (i // 2) % 2) for i in range(18)] + [(None, 1, 1), (3, None, None), (99, 1, 0)], "doc_id long, quality int, toxic int"
    )


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_top_k(spark):
    rng = np.random.default_rng(1)
    vectors = [(i, rng.normal(size=24).round(3).tolist()) for i in range(400)]
    vectors += [(i, vectors[7][1]) for i in range(400, 440)]  # ties
    vectors += [(500, None), (501, [1.0, None]), (502, [float("nan")]), (503, [float("inf")]), (504, [1.5]), (505, []), (None, [1.0])]
    vectors += [(600, [3e30] * 24), (601, [-3e30] * 24)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    got = defaultdict(list)
    for r in topk.top_k(df, df.filter("vec_id % 100 = 0"), k=5, query_block=2, part_rows=16).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    import math

    fine = {i: [math.floor(1024 * x) for x in v] for i, v in vectors if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    clip = lambda s: max(-(2**63), min(2**63 - 1, s))
    for q in [i for i in fine if i % 100 == 0 and i < 600]:
        best = sorted((-clip(sum(a * b for a, b in zip(fine[q], v, strict=False))), i) for i, v in fine.items() if i != q)[:5]
        assert got[q] == [(i, -s) for s, i in best]
    assert set(got) == {i for i in fine if i % 100 == 0}
    assert topk.top_k(df.limit(0), df.limit(0)).count() == 0


def test_top_k_takes_one_job_for_any_number_of_blocks(spark):
    """Every query's answers from blocks of one query and parts of few vectors, by as many jobs as from one block."""
    rng = np.random.default_rng(5)
    whole = np.floor(1024 * (rng.normal(size=(300, 12)) * rng.lognormal(size=(300, 1))).round(2))
    df = spark.createDataFrame([(i, (v / 1024).tolist(), "x") for i, v in enumerate(whole)], "vec_id long, embedding array<double>, v string")
    asked = df.filter("vec_id < 40")

    def answers(block, part):
        group = f"top-k-{block}"
        spark.sparkContext.setJobGroup(group, group)
        got = topk.top_k(df, asked, k=4, query_block=block, part_rows=part).orderBy("query_id", "rank").collect()
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return [(r.query_id, r.vec_id, r.score) for r in got], jobs

    (few, one), (many, other) = answers(4096, 4096), answers(1, 8)
    scores = whole[:40] @ whole.T
    want = [(q, i, int(scores[q, i])) for q in range(40) for i in sorted(set(range(300)) - {q}, key=lambda i: (-scores[q, i], i))[:4]]
    assert few == want and many == want
    assert abs(one - other) <= 2 and other < 40


def test_top_k_holds_few_pairs(monkeypatch):
    """What a search holds does not grow with its queries; lookups of pairs and products of matrices agree."""
    import tracemalloc

    rng = np.random.default_rng(9)
    vectors, asked = (np.floor(1024 * rng.normal(size=(n, 64))) for n in (1024, 1500))
    basis = np.linalg.qr(rng.normal(size=(64, 64)))[0]
    turned, norm = vectors @ basis, np.linalg.norm(vectors, axis=1)

    def best(number):
        search = topk.Search(np.arange(number) + 5000, asked[:number], basis, np.full(number, -np.inf), 10)
        tracemalloc.start()
        for _ in range(2):  # without thresholds, and with some
            search.offer(np.arange(1024), vectors, turned, norm)
            search.offer(np.arange(1024, 1024 + 300), vectors[:300], turned[:300], norm[:300])
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return search, peak / 1e6

    (_, few), (search, many) = best(100), best(1500)
    assert many < 400 and many < 2 * few + 100
    monkeypatch.setattr(topk, "DENSE", 1)  # pairs are looked up, but for those without a threshold
    looked, _ = best(1500)
    assert (search.q == looked.q).all() and (search.vec == looked.vec).all() and (search.score == looked.score).all()
    scores = asked[:3] @ vectors.T
    assert sorted(search.score[search.q == 2].tolist())[-1] == int(scores[2].max())


def test_exact_dedup(spark, odd, empty):
    keep, size = {}, Counter()
    norm = lambda t: " ".join(f"|{t or ''}|".split()).encode()
    data = [(r.doc_id, norm(r.text)) for r in odd.collect()]
    for i, t in data:
        size[t] += 1
        if i is not None:
            keep[t] = min(i, keep.get(t, i))
    want = sorted(((i, keep.get(t), size[t], i == keep.get(t)) for i, t in data), key=str)
    got = [(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.deduplicate(odd).collect()]
    assert sorted(got, key=str) == want
    index = exact_dedup.DigestIndex.temporary(spark)
    first = odd.filter("doc_id >= 8")
    exact_dedup.deduplicate(first, index)
    exact_dedup.deduplicate(first, index)
    later = {r.doc_id: r.keep_id for r in exact_dedup.deduplicate(odd.filter("doc_id < 8"), index).collect()}
    assert index.table().count() == index.table().select("digest").distinct().count() == len({t for i, t in data if i is not None})
    assert later[6] == 6 and later[3] == 3
    assert exact_dedup.deduplicate(empty).count() == 0
    assert sorted(exact_dedup.distinct_documents(odd).columns) == sorted(odd.columns)
    plan = exact_dedup.deduplicate(odd)._jdf.queryExecution().toString()
    assert "SortMergeJoin" in plan and "Python" not in plan


def test_language_codes(spark, odd, empty):
    rng = random.Random(5)
    sets = {"aa": "bana kato milu sopa".split(), "bb": "strz przy wszk chrz".split(), "cc": "うみ そら やま かわ".split()}
    rows = [(i, " ".join(rng.choices(sets[k], k=30)), k) for i, k in enumerate("aa bb cc".split() * 40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = language_id.identify(df).collect()
    assert all(r.lang_pred == rows[r.doc_id][2] for r in found)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    got = language_id.identify(odd).collect()
    assert len(got) == odd.count() and all(r.lang_pred == "und" for r in got if r.doc_id in (0, 1, 2))
    assert all(0 <= r.score <= 1 and r.lang_pred in ("und", "en", "de") for r in got)
    assert language_id.identify(empty).count() == 0
    codes = language_id.codewords(6)
    assert min((codes[a] != codes[b]).sum() for a in range(6) for b in range(a)) >= 5


def test_quality_rules(spark, sf_dir, odd, labels, empty):
    docs, known = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    found = quality.quality_scores(docs, known).join(known, "doc_id").filter("held_out")
    assert found.filter("predicted = quality").count() / found.count() > 0.95
    got = quality.quality_scores(odd, labels).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert quality.quality_scores(empty, labels).count() == 0
    assert quality.quality_scores(odd, labels.limit(0)).filter("score <> 0.5").count() == 0
    assert quality.good_documents(odd, labels).columns == odd.columns


def test_mix(spark, odd, empty):
    got = mixing.mix(odd).collect()
    sizes = defaultdict(int)
    for r in odd.collect():
        sizes[r.source] += len(words_of(r.text))
    taken = defaultdict(int)
    for r in got:
        taken[r.source] += r.taken
        assert r.source_size == sizes[r.source] and 0 <= r.taken <= 2 * r.size
    level = {r.source: r.target for r in got}
    weights = dict(zip(sorted(filter(None, sizes)) + [None], (3, 1, 2, 3), strict=False))
    left, stopped = 1.5 * sum(sizes.values()), set()
    while True:
        w = sum(weights[s] for s in sizes if s not in stopped)
        new = {s for s in sizes if s not in stopped and left * weights[s] / w > 2 * sizes[s]}
        if not new:
            break
        stopped |= new
        left -= sum(2 * sizes[s] for s in new)
    for s in sizes:
        assert level[s] == pytest.approx(2 * sizes[s] if s in stopped else left * weights[s] / w)
        assert abs(taken[s] - level[s]) < 4
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mixing.mix(odd.repartition(5)).collect()), key=str)
    assert mixing.mix(empty).count() == 0
    assert mixing.mixed_documents(odd).columns == odd.columns


def removed_by_hand(rows, window):
    first = {}
    for i, t in rows:
        w = words_of(t)
        for k in range(len(w) - window + 1):
            if i is not None:
                key = tuple(w[k : k + window])
                first[key] = min(i, first.get(key, i))
    out = []
    for i, t in rows:
        w = words_of(t)
        gone = {j for k in range(len(w) - window + 1) if i is not None and first[tuple(w[k : k + window])] < i for j in range(k, k + window)}
        out.append((i, len(w), len(gone), b" ".join(x for j, x in enumerate(w) if j not in gone).decode()))
    return sorted(out, key=str)


def test_hashes_of_words_and_places_of_anchors():
    """From bytes at once, over cuts of long texts: one hash a word, wherever it stands; the first of the least."""
    hasher, rng = phrases.Hasher(), np.random.default_rng(3)
    vocabulary = ["a", "aa", "ab", "ba", "ção", "\u00a0x", "x" * 70_000, *map(str, range(500))]
    words = [vocabulary[i] for i in rng.integers(0, len(vocabulary), 4000)]
    spaces = [" ", "\n", "\t \r", "\x0b\x0c"]
    text = " " + "".join(w + spaces[i % 4] for i, w in enumerate(words))
    hashes = hasher.of(text.encode())
    known = {w: hasher.of(w.encode()).tolist() for w in vocabulary}
    assert [h for w in words for h in known[w]] == hashes.tolist() and len({h for v in known.values() for h in v}) == len(vocabulary)
    assert len(hasher.of(b" \n ")) == len(hasher.of(b"")) == 0
    for n, span in ((43, 43), (500, 43), (9, 1), (30, 5)):
        grams = rng.integers(0, 6, n, dtype=np.uint64) << np.uint64(40)
        runs = np.lib.stride_tricks.sliding_window_view(grams, span)
        assert phrases.least_places(grams, span).tolist() == (runs.argmin(axis=1) + np.arange(n - span + 1)).tolist()


def test_remembered_grams_and_pairs_give_the_same():
    """Scores of words by remembered grams, also when these are forgotten; pairs are counted as they occur."""
    words = ["casa", "casas", "caso", "", "ação", "a"]
    rows = [("", s, 5) for s in "acso\n\t"] + [("a", "s", 9), ("cas", "a", 4)]
    tree = suffix_tree.SuffixTree.grow(rows, gain=-100.0)

    def plain(word):
        s = suffix_tree.START + suffix_tree.spelling(word)
        return sum(tree.log10(s[max(0, e - suffix_tree.DEPTH) : e], s[e]) for e in range(4, len(s)))

    assert [tree.rest(w) for w in words * 2] == [plain(w) for w in words * 2] and tree.grams
    ids, before = np.array([0, 1, 0, 3, 5, 0]), np.array([2, 0, 2, 0, 1, 2])
    for j, (pairs, n, of) in enumerate(suffix_tree.Joints(words).pairs(ids, before)):
        k = suffix_tree.TAILS[j]
        spelt = [(words[b][-k:], suffix_tree.spelling(words[i])[: j + 1]) if len(suffix_tree.spelling(words[i])) > j else None for i, b in zip(ids, before)]
        assert [pairs[p] if p >= 0 else None for p in of] == spelt
        assert dict(zip(pairs, n.tolist())) == {p: spelt.count(p) for p in spelt if p}


def test_repeated_phrases(spark, odd, empty):
    got = sorted((tuple(r) for r in phrases.remove_repeats(odd, bucket_bytes=4000).collect()), key=str)
    assert got == removed_by_hand([(r.doc_id, r.text) for r in odd.collect()], 50)
    rng = random.Random(9)
    passage = [f"p{i}" for i in range(70)]
    rows = []
    for i in range(60):
        cut = sorted(rng.sample(range(71), 2))
        own = [rng.choice("xyz") for _ in range(rng.randrange(60))]
        rows.append((i, " ".join(own + passage[cut[0] : cut[1]] + own[::-1])))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in phrases.remove_repeats(df, window=12, anchor=4, bucket_bytes=1500).collect()), key=str)
    assert got == removed_by_hand(rows, 12)
    assert phrases.remove_repeats(empty).count() == 0


def test_one_id_of_many_rows_is_dealt_to_many_tasks(spark):
    """A third of all rows with one id, equal and unequal texts among them, and a third without an id."""
    rng = random.Random(8)
    passage = [f"p{i}" for i in range(70)]
    text = lambda: " ".join([rng.choice("xyz") for _ in range(20)] + passage[rng.randrange(40) :])
    rows = [(i, text()) for i in range(30)] + [(7, text()) for _ in range(30)] + [(None, text()) for _ in range(30)]
    rows += [(7, rows[40][1])] * 9 + [(7, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted((tuple(r) for r in phrases.remove_repeats(df, window=12, anchor=4, bucket_bytes=900).collect()), key=str)
    assert got == removed_by_hand(rows, 12)


def test_automata_are_sharded():
    import pandas as pd

    frame = pd.DataFrame({"source": [1, 2], "place": [0, 0], "words": ["a b c d e", "f g h i j"]})
    assert len(list(phrases.shards(frame, 4, 2, most=6))) == 2


def test_suffix_tree_scores(spark, odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    low = lambda t: (t or "").encode().lower().split() + [b""]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    c = Counter(w for i, t in rows if not held(i) for w in low(t))
    n, v = sum(c.values()), len(c)
    want = sorted(
        ((i, held(i), len(low(t)), sum(c[w] > 0 for w in low(t)), n, round(sum(log10((c[w] + 1) / (n + v + 1)) for w in low(t)), 6)) for i, t in rows), key=str
    )
    found = suffix_tree.lm_scores(odd).collect()
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found), key=str)
    assert got == want and all(r.score < 0 for r in found)
    assert suffix_tree.lm_scores(empty).count() == 0


def test_suffix_tree_is_a_distribution():
    grams = suffix_tree.longest_grams(["ab", "abc", "b", ""], np.array([5, 3, 2, 4]), 3)
    assert dict(zip(grams["gram"], grams["n"], strict=True))[" ab"] == 8
    rows = Counter()
    for g, n in zip(grams["gram"], grams["n"], strict=True):
        for b in range(len(g)):
            rows[g[b:]] += n
    tree = suffix_tree.SuffixTree.grow([(g[:-1], g[-1], n) for g, n in rows.items()], gain=0.1)
    assert len(tree.left) > 1
    for context in ("", " ", " a", "ab", "zz"):
        seen = [s for s in ["a", "b", "c", suffix_tree.END, suffix_tree.STOP]]
        spare = 1 - sum(10 ** tree.log10(context, s) for s in seen)
        assert spare == pytest.approx((0x110000 + 2 - len(seen)) * 10 ** tree.log10(context, "q"), rel=1e-6)


def test_toxicity(spark, odd, labels, empty):
    docs, known = spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    some = docs.join(known, "doc_id", "left_semi")
    found = toxicity.toxicity_scores(some, known).join(known, "doc_id").filter("held_out")
    assert found.filter("predicted = toxic").count() / found.count() > 0.97
    assert found.filter("toxic = 1 and predicted = 1").count() / found.filter("toxic = 1").count() > 0.85
    got = toxicity.toxicity_scores(odd, labels).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert toxicity.toxicity_scores(empty, labels).count() == 0
    assert toxicity.toxicity_scores(odd, labels.limit(0)).filter("score <> 0").count() == 0


def test_toxicity_learns_from_words_that_occur_once(spark):
    """Every text has one word of its own; those of toxic texts have a stem in common."""
    rng = random.Random(13)
    common = [f"{a}{b}{c}" for a in "bdfglm" for b in "aeiou" for c in ("n", "rt", "st")]
    own = lambda n: "".join(rng.choice("aeioubcdfglmnprst") for _ in range(n))
    rows = []
    for i in range(1200):
        toxic = i % 4 == 0
        words = [rng.choice(common) for _ in range(12)]
        words.insert(rng.randrange(12), "kwyx" + own(4) if toxic else own(8))
        rows.append((i, " ".join(words), int(toxic)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    known = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    held = toxicity.toxicity_scores(docs, known).filter("held_out").join(known, "doc_id").groupBy("toxic", "predicted").count().collect()
    n = {(r["toxic"], r["predicted"]): r["count"] for r in held}
    assert n.get((1, 1), 0) >= 0.95 * (n.get((1, 1), 0) + n.get((1, 0), 0)) and n.get((0, 1), 0) <= 2


def test_kneser_ney_probabilities(spark):
    """Every log ratio against dictionaries of strings, and what neither class has against the shares left over."""
    rng = random.Random(3)
    words = Counter("".join(rng.choice("abcé") for _ in range(rng.randrange(1, 7))) for _ in range(120))
    order, grams = 4, defaultdict(lambda: [0, 0])
    for i, w in enumerate(words):
        s = toxicity.START + w + toxicity.END
        for e in range(2, len(s) + 1):
            grams[s[max(0, e - order) : e]][i % 3 == 0] += words[w]
    ends = {g[k:] for g in grams for k in range(len(g))}
    cont = Counter(x[1:] for x in ends if len(x) > 1)
    d = toxicity.SHARED_DISCOUNT

    def shared(g):
        if not g:
            return 1e-4
        total = sum(n for x, n in cont.items() if x[:-1] == g[:-1] and len(x) == len(g))
        kinds = sum(1 for x, n in cont.items() if x[:-1] == g[:-1] and len(x) == len(g))
        return max(cont[g] - d, 0) / total + d * kinds / total * shared(g[1:]) if total else shared(g[1:])

    cut = lambda n: toxicity.DISCOUNTS[min(n, 3)]
    def given(g, c):
        after = [n[c] for x, n in grams.items() if x[:-1] == g[:-1]]
        total, spare = sum(after), sum(map(cut, after))
        return (grams[g][c] - cut(grams[g][c]) + spare * shared(g[1:])) / total if total else shared(g[1:])

    names = sorted(grams)
    rows = toxicity._aligned(names, order)
    model = toxicity.KneserNey.fit(rows, np.array([grams[g][1] for g in names], float), np.array([grams[g][0] for g in names], float))
    place = {h: i for i, h in enumerate(model.grams.tolist())}
    for g, h in zip(names, toxicity._hashes(rows).tolist(), strict=True):
        assert model.ratio[place[h]] == pytest.approx(np.log(given(g, 1)) - np.log(given(g, 0)), abs=1e-9)
    known = list(words)[:20]
    for w, got in zip(known, model.words(known), strict=True):
        s = toxicity.START + w + toxicity.END
        want = [s[max(0, e - order) : e] for e in range(2, len(s) + 1)]
        assert got == pytest.approx(sum(np.log(given(g, 1)) - np.log(given(g, 0)) for g in want))
    assert model.words(["zz"])[0] == pytest.approx(0.0, abs=10) and len(model.words([])) == 0


def fingerprint_by_hand(text):
    words = words_of(text)
    words = [w.lower() for w in words]
    shingles = [b" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    ones = [sum(xxhash.xxh64(s, seed=42).intdigest() >> b & 1 for s in shingles) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


@pytest.mark.parametrize("segments", [1, 4])
def test_close_pairs(spark, segments):
    rng = random.Random(2)
    base = [rng.getrandbits(64) for _ in range(40)]
    near = [b ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for b in base for _ in range(3)]
    fps = sorted({*base, *near, 0, 1, 3, 7, 2**63})
    df = spark.createDataFrame([(f - 2**64 if f >= 2**63 else f,) for f in fps], "fp long")
    got = {tuple(sorted(x % 2**64 for x in r)) for r in simhash.close_pairs(df, segments=segments, tile=7).collect()}
    assert got == {(a, b) for i, a in enumerate(fps) for b in fps[i + 1 :] if (a ^ b).bit_count() <= 2}


def test_near_duplicates(spark, odd, empty):
    rows = [(r.doc_id, fingerprint_by_hand(r.text)) for r in odd.collect()]
    group = list(range(len(rows)))
    for _ in rows:
        for a in range(len(rows)):
            for b in range(len(rows)):
                if (rows[a][1] ^ rows[b][1]).bit_count() <= 2:
                    group[a] = group[b] = min(group[a], group[b])
    least = defaultdict(lambda: None)
    for (i, _), g in zip(rows, group, strict=True):
        if i is not None:
            least[g] = i if least[g] is None else min(i, least[g])
    want = sorted(((i, f, least[g]) for (i, f), g in zip(rows, group, strict=True)), key=str)
    got = sorted(((r.doc_id, r.fp % 2**64, r.component_id) for r in simhash.near_duplicates(odd).collect()), key=str)
    assert got == want
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.representatives(odd).columns == odd.columns


def test_components(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, k) for k in range(101, 120)] + [(205, 203), (203, 204)]
    found = dict(tuple(r) for r in roots(spark.createDataFrame(links, "a long, b long")).collect())
    assert {found.get(i, i) for i in range(31)} == {0} and {found[k] for k in range(101, 120)} == {100}
    assert found[205] == found[204] == 203


def test_packing(spark, odd, empty):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    got = packing.best_fit_sequences(odd, capacity=256).collect()
    want = Counter()
    for r in odd.collect():
        ids = np.array(tokenizer.encode(r.text or "", add_special_tokens=False).ids + [0], dtype="<u4")
        start, length, piece = 0, len(ids) % 256 or 256, 0
        while start < len(ids):
            want[r.doc_id, piece, start, length, zlib.crc32(ids[start : start + length].tobytes())] += 1
            start, length, piece = start + length, 256, piece + 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    ends = defaultdict(int)
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends[r.sequence_id]
        ends[r.sequence_id] += r.length
    assert max(ends.values()) <= 256
    assert packing.best_fit_sequences(empty).count() == 0


def test_packing_plan_is_close_to_the_bound():
    rng = random.Random(4)
    counts = Counter(min(2048, int(rng.expovariate(1 / 700)) + 1) for _ in range(20_000))
    runs, bins = packing.pack(dict(counts))
    assert sum(r.count for r in runs) == 20_000
    assert bins <= 1.02 * sum(k * n for k, n in counts.items()) / 2048 + 1


def test_encoder_equals_the_tokenizer():
    encoder = packing.Encoder(packing.tokenizer_path())
    for text in ["a  b", " lead", "trail ", "x\n\n foo  \t bar  baz", "  ", "\n", "it's  o' 12 34", "　 x", "a \x1c b", "", "word, word. w.,"]:
        want = np.array(encoder.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        assert encoder.encode([text]) == [want]


def test_encoder_gives_the_ids_of_the_file(spark):
    """Every character between letters, digits, marks and blanks; added tokens; texts without units to part them."""
    encoder = packing.Encoder(packing.tokenizer_path())
    assert encoder.same is not None
    rng = random.Random(5)
    letters = "über café naïve, straße. ǆ ß × ÷ ñandú Éan onst.\nHeshes 日本 語. á à́ \xa0é ŉ ı İ 🙂 a. ﬁ it's they'LL 1² ½Ⅻ \u2003\u200b\t"
    texts = ["", letters, "a <|endoftext|> b<|endoftext|><|endoftext|>", "<|endoftext", "ab" * 50_000, " " * 3000 + "x", "\r\n\r\n a"]
    texts += ["".join(rng.choices(letters + "aeiou  ", k=rng.randrange(1, 200))) for _ in range(500)]
    shown = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x3000 or c % 61 == 0)]
    texts += [f"a{chr(c)}b1{chr(c)}2 {chr(c)} .{chr(c)}!{chr(c)}\n{chr(c)}{chr(c)}x" for c in shown]
    want = [np.array(e.ids, dtype="<u4").tobytes() for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert encoder.encode(texts) == want
    encoder.same = None
    assert encoder.encode(texts[:50]) == want[:50]


def test_other_tokenizers_are_not_taken_for_the_same():
    from tokenizers import Tokenizer, models, pre_tokenizers

    letters = packing._byte_letters()
    vocabulary = {c: i for i, c in enumerate(letters)} | {"ab": 300, "abc": 290}
    for merges in ([("a", "b"), ("ab", "c")], [("ab", "c"), ("a", "b")]):
        other = Tokenizer(models.BPE(vocab=vocabulary, merges=merges))
        other.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
        assert packing._same_merges(other) is None or merges[0] == ("ab", "c") and other.encode("abc").ids == [290]
    other.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    assert packing._same_merges(other) is None


def test_packing_spreads_copies_without_an_id(spark):
    """Equal rows without an id do not meet in one group of ranks."""
    rows = spark.createDataFrame([(None, "the same words") for _ in range(400)], "doc_id long, text string").repartition(20)
    pieces = packing.tokenised_pieces(rows).select(F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", "task"), F.lit(16)).alias("s"))
    assert pieces.distinct().count() > 5
    got = packing.best_fit_sequences(rows, capacity=64)
    assert got.count() == got.select("sequence_id", "offset").distinct().count() == 400


def test_pipeline_stages(spark, sf_dir, odd, labels, tmp_path):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    docs = odd
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, str(tmp_path))
        assert kept.columns == docs.columns
        assert not set(r.text for r in kept.collect()) - set(r.text for r in docs.collect())
        docs = kept
    final = corpus_pipeline.run(spark, sf_dir)
    assert final.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 2048").count() == 0


@pytest.mark.parametrize("name", sorted(queries.statements()))
def test_query(name, spark, sf_dir):
    assert compare(queries.registered()[name](spark, sf_dir), connect(sf_dir), queries.statements()[name]) is None


def test_digests_are_of_the_normalised_text(spark):
    df = spark.createDataFrame([(1, "a \t b\n")], "doc_id long, text string")
    assert exact_dedup.digests(df).first().digest == bytearray(hashlib.sha256(b"a b ").digest())


def test_every_distinct_text_stays_once(spark, odd, empty):
    rows = [(None, "a b"), (None, "c d"), (None, "a  b"), (None, "e"), (7, "x y"), (7, "z"), (7, "x y"), (8, "z"), (9, "e"), (10, None), (None, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(((r.doc_id, r.text) for r in exact_dedup.distinct_documents(df).collect()), key=str)
    assert got == sorted([(None, "a  b"), (None, "c d"), (9, "e"), (7, "x y"), (7, "z"), (10, None)], key=str)
    assert exact_dedup.distinct_documents(empty).count() == 0
    norm = lambda t: re.sub(r"\s+", " ", t or "")
    kept = Counter(norm(r.text) for r in exact_dedup.distinct_documents(odd).collect())
    assert kept == Counter({norm(r.text) for r in odd.collect()})


def shingles_by_hand(text):
    words = [w.lower() for w in words_of(text)]
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def alike(a, b):
    return a == b or 5 * len(a & b) >= 4 * len(a | b)


def kept_by_hand(rows):
    """Smallest (no id, id) of every component of rows (doc_id, text) at similarity 0.8."""
    sets = [shingles_by_hand(t) for _, t in rows]
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if group[a] != group[b] and alike(sets[a], sets[b]):
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    best = {}
    for (i, _), g in zip(rows, group, strict=True):
        best[g] = min(best.get(g, (True, 0)), (i is None, i or 0))
    return sorted(best.values())


def test_near_copies_leave_the_corpus(spark, odd, empty):
    rng = random.Random(11)
    rows = []
    for base in range(60):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.randrange(60, 400))]
        rows.append((len(rows), " ".join(words)))
        for _ in range(4):  # a changed word touches five shingles: similarities from about 0.6 to 0.98
            copy = list(words)
            for at in rng.sample(range(len(copy)), max(1, int(len(copy) * rng.uniform(0.003, 0.045)))):
                copy[at] = "changed" + str(rng.random())
            rows.append((len(rows), " ".join(copy)))
    pairs = [(len(a & b) / len(a | b)) for a, b in ((shingles_by_hand(rows[i][1]), shingles_by_hand(rows[i + 1][1])) for i in range(0, 300, 5))]
    assert sum(0.8 <= p < 0.95 for p in pairs) >= 15 and sum(p < 0.8 for p in pairs) >= 5
    rows += [(None, rows[0][1] + " tail"), (None, "one text without an id"), (None, "and one more text without an id")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [(r.doc_id is None, r.doc_id or 0) for r in corpus_pipeline.unlike(spark, df, "").collect()]
    assert sorted(got) == kept_by_hand(rows)
    some = [(r.doc_id, r.text) for r in odd.collect()]
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in near_copies.representatives(odd).collect()) == kept_by_hand(some)
    assert near_copies.representatives(odd).columns == odd.columns
    assert near_copies.representatives(empty).count() == 0


def test_components_of_near_copies_reach_over_chains(spark):
    """Copies of copies: neighbours are alike, the ends are not, and no node is alike to all."""
    rng = random.Random(12)
    words = [f"w{rng.randrange(5000)}" for _ in range(300)]
    rows = []
    for i in range(30):
        rows.append((i, " ".join(words)))
        words = list(words)
        words[i * 10 : i * 10 + 5] = [f"c{i}x{k}" for k in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert [r.doc_id for r in near_copies.representatives(df).collect()] == [0]


def test_the_root_knows_every_symbol(spark):
    """A letter seen 2,000 times among 3e10 symbols keeps its probability."""
    rows = [("", "e", 30_000_000_000), ("", "ა", 2000), ("e", "e", 20_000_000_000), ("e", "ა", 2000), ("ა", "e", 2000)]
    kept = suffix_tree.frequent(spark.createDataFrame(rows, "context string, symbol string, n long")).collect()
    assert {(r.context, r.symbol) for r in kept} == {("", "e"), ("", "ა"), ("e", "e")}
    tree = suffix_tree.SuffixTree.grow([tuple(r[c] for c in ("context", "symbol", "n")) for r in kept])
    assert tree.log10("", "ა") == pytest.approx(log10(2000 / 3e10), abs=0.01)


def test_language_sample_orders_few_ids(spark):
    ids = spark.range(20_000).selectExpr("id as doc_id", "if(id % 50 = 0, 'bb', 'aa') as lang")
    found = language_id.sampled(ids, 300)
    want = ids.selectExpr("*", "row_number() over (partition by lang order by xxhash64(doc_id), doc_id) r").filter("r <= 300").drop("r")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))
    assert "LeftSemi" in found._jdf.queryExecution().toString()  # ids are cut by their ranges before they are ordered


def test_codewords_stay_apart_with_many_languages():
    for languages in (2, 6, 12, 40, 1000):
        assert language_id.distance(language_id.enough_codewords(languages)) >= 4
    assert language_id.enough_codewords(6).shape == (6, language_id.BITS)
