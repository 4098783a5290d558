"""Benchmark decontamination against windows held in a Python set."""

import hashlib
import random
import re

import numpy as np
import pytest

from ouvidoria.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_by_hand(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(low)


def windows_by_hand(words, window):
    n = min(window, len(words))
    return {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} if n else set()


def by_hand(docs, items, window):
    of = {}
    for i, t in items:
        for w in windows_by_hand(words_by_hand(t), window):
            of.setdefault(w, set()).add(i)
    sizes = {len(w) for w in of}
    out = []
    for d, t in docs:
        words, hit, ids = words_by_hand(t), set(), set()
        for n in sizes:
            for k in range(len(words) - n + 1):
                found = of.get(tuple(words[k : k + n]))
                if found is not None:
                    hit |= set(range(k, k + n))
                    ids |= {str(i) for i in found if i is not None}
        sha = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out.append((d, len(words), len(hit), len(ids), sha, bool(hit)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(8)
    vocabulary = [f"{a}{b}" for a in "bcdfgh" for b in ("a", "é", "o1", "ul")]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.randrange(1, 45))) for i in range(30)]
    items += [(30, None), (31, ""), (32, " .,! "), (33, items[3][1]), (34, items[4][1] + " " + items[5][1]), (None, text(20)), (35, text(12)), (35, text(12))]
    items += [(36, "Solo"), (37, "two words"), items[6], (38, "ÀÉ ǅ straße Ⅻ 日本 語")]
    docs = [(i, text(rng.randrange(0, 120))) for i in range(60)]
    for i in range(60, 120):
        part = words_by_hand(rng.choice(items)[1])
        a = rng.randrange(0, max(1, len(part)))
        b = rng.randrange(a, len(part) + 1)
        docs.append((i, f"{text(rng.randrange(0, 9))}, {'-'.join(part[a:b]).upper()}! {text(rng.randrange(0, 9))}"))
    docs += [(120, None), (121, ""), (122, " \t"), (None, items[8][1]), (123, (items[9][1] + " ") * 400), docs[70], docs[70], (70, "another text")]
    docs += [(124, "a solo b"), (125, "xx two  WORDS"), (126, "ÀÉ ǅ straße Ⅻ 日本 語"), (127, "àé ǅ straße Ⅻ 日本 語"), (128, "absent" * 5000)]
    d = spark.createDataFrame([(*r, 1, "x") for r in docs], "doc_id long, text string, n_words int, items string").repartition(3)
    b = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, doc_id string").repartition(2)
    return docs, items, d, b


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("options", [{}, {"shard_words": 100, "block_words": 150}, {"window": 4, "shard_words": 1}])
def test_contamination(spark, tables, options):
    docs, items, d, b = tables
    want = by_hand(docs, items, options.get("window", 10))
    assert any(r[5] for r in want) and not all(r[5] for r in want)
    assert rows_of(decontaminate.contamination(d, b, **options)) == want


def test_empty_tables(spark, tables):
    docs, _, d, b = tables
    assert decontaminate.contamination(d.limit(0), b).count() == 0
    clear = decontaminate.contamination(d, b.limit(0))
    assert clear.count() == len(docs) and clear.filter("contaminated or n_items > 0").count() == 0


def test_clean_documents(spark, tables):
    docs, items, d, b = tables
    bad = {t for t in {t for _, t in docs} if by_hand([(0, t)], items, 10)[0][5]}
    kept = decontaminate.clean_documents(d, b)
    assert kept.columns == d.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(((i, t) for i, t in docs if t not in bad), key=str)


def test_longest_matches(spark, tables):
    docs, items, d, b = tables
    want = set()
    for i, t in docs:
        words = words_by_hand(t)
        for j, u in items:
            own = words_by_hand(u)
            n = min(10, len(own))
            if not n:
                continue
            for p in range(len(words)):
                for q in range(len(own)):
                    if p and q and words[p - 1] == own[q - 1]:
                        continue
                    m = 0
                    while p + m < len(words) and q + m < len(own) and words[p + m] == own[q + m]:
                        m += 1
                    if m >= n:
                        want.add((i, p, m, j, q))
    assert {tuple(r) for r in decontaminate.longest_matches(d, b, shard_words=500).collect()} == want


def test_suffix_array_is_sorted_and_finds_every_place():
    rng = np.random.default_rng(3)
    items = decontaminate.prepared([(1, [b"%d" % x for x in rng.integers(0, 6, 60)])], 5)
    numbers = rng.integers(0, 7, 3000)
    array = decontaminate.SuffixArray(numbers, items)
    suffixes = [numbers[a : a + 5].tolist() for a in array.at]
    assert suffixes == sorted(suffixes)
    at, window = array.places(items)
    distinct = [items.numbers[items.starts[np.flatnonzero(items.window_of == w)[0]] :][:5].tolist() for w in range(len(items.lengths))]
    want = [(p, distinct.index(numbers[p : p + 5].tolist())) for p in range(2996) if numbers[p : p + 5].tolist() in distinct]
    assert list(zip(at.tolist(), window.tolist(), strict=True)) == want
