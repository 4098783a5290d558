"""Near copies: tiles against single pairs, and how the work grows with a group whose members are not alike enough."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ouvidoria.llm import exact_dedup, near_copies, simhash


def test_common_counts():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 60, rng.integers(0, 40))) for _ in range(25)]
    a, b = sets[:10], sets[10:]
    assert near_copies.common_counts(a, b).tolist() == [[len(np.intersect1d(x, y)) for y in b] for x in a]
    assert near_copies.common_counts([], b).shape == (0, 15)


def test_joining_links_span_the_components():
    base = np.arange(100)
    sets = [base + shift for shift in (0, 5, 10, 500, 505, 900)]
    links = near_copies.joining_links([1, 2, 3, 4, 5, 6], sets, [1, 2, 3, 4, 5, 6], sets)
    assert len(links) == 3 and {x for link in links for x in link} == {1, 2, 3, 4, 5}


@pytest.mark.parametrize("tile", [300, 200_000])
def test_tiles_do_not_matter(spark, tile):
    """Links of copies of copies over many small tiles, or one."""
    rng = random.Random(4)
    nodes, at = [], list(range(200))
    for i in range(40):
        nodes.append((i, sorted(at)))
        at = list(at)
        at[i * 4 % 200 : i * 4 % 200 + 4] = [10_000 + 10 * i + k for k in range(4)]
    rng.shuffle(nodes)
    sets = spark.createDataFrame(nodes, "node long, hashes array<long>")
    placed = sets.select(F.lit(7).cast("long").alias("band"), "node", F.size("hashes").alias("size"), F.col("node").alias("root"))
    links = {tuple(r) for r in near_copies.tiled_links(placed, sets, tile).collect()}
    parent = list(range(40))
    for a, b in links:
        assert 5 * len(set(dict(nodes)[a]) & set(dict(nodes)[b])) >= 4 * len(set(dict(nodes)[a]) | set(dict(nodes)[b]))
        old, new = parent[a], parent[b]
        parent = [new if p == old else p for p in parent]
    assert len(set(parent)) == 1


def copies(n, seed=5):
    """Of one text of 300 words, each with five words changed: most pairs are 0.71 alike."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(300)]
    rows = []
    for i in range(n):
        own = list(base)
        for at in rng.sample(range(300), 5):
            own[at] = f"c{rng.random()}"
        rows.append((i, " ".join(own)))
    return rows


def test_rows_grow_in_proportion(spark, monkeypatch):
    made = []
    links = near_copies.tiled_links

    def counted(placed, sets, *options):
        out = links(placed, sets, *options)
        made.append((placed.count(), out.count()))
        return out

    monkeypatch.setattr(near_copies, "tiled_links", counted)
    kept = []
    for n in (50, 100, 200):
        df = spark.createDataFrame(copies(n), "doc_id long, text string").repartition(3)
        kept.append(near_copies.representatives(df).count())
    (open_50, _), _, (open_200, links_200) = made
    assert open_200 <= 4.6 * open_50 + 50 and links_200 <= open_200
    assert all(k > n / 2 for k, n in zip(kept, (50, 100, 200), strict=True))


def test_recall_of_the_bands():
    """Pairs of similarity 0.8 share a band."""
    rng = np.random.default_rng(8)
    hit = 0
    for _ in range(300):
        common = rng.integers(0, 2**64, 240, dtype=np.uint64)
        a, b = (np.unique(np.r_[common, rng.integers(0, 2**64, 30, dtype=np.uint64)]) for _ in range(2))
        hit += (near_copies.band_values(a) == near_copies.band_values(b)).any()
    assert hit == 300


def test_stages_keep_any_columns(spark, tmp_path):
    """Dots, maps and structs with maps go through every stage as they are."""
    rows = [(i, f"A good text of number {i // 2}, with some words to spare. " * 4, "en", "s", 10, {"k": i}, (1, {"m": "v"}), 2.5) for i in range(12)]
    rows += [rows[0], rows[0]]
    schema = "doc_id long, text string, lang string, source string, n_chars long, `a.b` map<string,int>, `c.d` struct<x:int,y:map<string,string>>, row double"
    docs = spark.createDataFrame(rows, schema).repartition(2)
    spark.createDataFrame([(i, 1, 0) for i in range(12)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.dtypes == docs.dtypes, name
        assert {str(r) for r in out.collect()} <= {str(r) for r in docs.collect()}
    assert exact_dedup.distinct_documents(docs).count() == 6


def test_hot_text_meets_by_its_id(spark, plan):
    df = spark.range(0, 4000, numPartitions=4).select(F.col("id").alias("doc_id"), F.lit("the same").alias("text"))
    places = df.limit(1).select(exact_dedup.digest_column().alias("digest"), F.col("doc_id").alias("stay"))
    found = exact_dedup.rows_at(df, places)
    dealt = [line for line in plan(found).splitlines() if "hashpartitioning(of" in line]
    assert len(dealt) == 2 and all("nameless" in line and "id#" in line for line in dealt)
    assert found.count() == 1


def test_simhash_components_give_candidates(spark, monkeypatch):
    """Without any MinHash band, copies with one word changed still meet, and are still confirmed on whole sets."""
    rng = random.Random(8)
    base = [f"w{i}" for i in range(3000)]
    other = [f"v{rng.randrange(10**6)}" for _ in range(3000)]
    changed = list(base)
    changed[1500] = "x"
    rows = [(2, " ".join(changed)), (1, " ".join(base)), (3, " ".join(other)), (4, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    prints = [simhash.majority(near_copies.shingle_set(t)) for _, t in rows[:2]]
    assert 0 < (prints[0] ^ prints[1]).bit_count() <= simhash.RADIUS
    make = near_copies.signatures
    monkeypatch.setattr(near_copies, "signatures", lambda docs: make(docs).withColumn("bands", F.array("node")))
    assert sorted(r.doc_id for r in near_copies.representatives(df).collect()) == [1, 3, 4]


def test_majority_of_hashes():
    hashes = np.random.default_rng(5).integers(0, 2**64, 70_001, dtype=np.uint64)
    bits = [sum(int(h) >> k & 1 for h in hashes.tolist()) * 2 > len(hashes) for k in range(64)]
    assert simhash.majority(hashes) == sum(b << k for k, b in enumerate(bits))
    assert simhash.majority(hashes[:0]) == 0
