"""Fits, decoding and pipeline stages against plain versions of themselves."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ouvidoria.llm import language_id, mixing, packing, quality
from ouvidoria.llm.common import fold, table


def test_lasso_is_at_its_optimum():
    """The conditions under which no other weights have a smaller penalised loss."""
    rng = np.random.default_rng(2)
    z = (rng.random((400, 12)) < 0.4).astype(float)
    y = (z[:, 0] + z[:, 1] - z[:, 2] + rng.normal(size=400) > 0.4).astype(float)
    w, b = quality.lasso(z, y, 0.01, rounds=20_000)
    error = 1 / (1 + np.exp(-(z @ w + b))) - y
    gradient = z.T @ error / len(y)
    assert abs(error.mean()) < 1e-5 and 0 < (w == 0).sum() < 12
    assert np.abs(gradient[w == 0]).max() <= 0.01 + 1e-5
    assert gradient[w != 0] == pytest.approx(-0.01 * np.sign(w[w != 0]), abs=1e-5)


def plain_score(ensemble, values):
    total = ensemble.intercept
    for rule, weight in ensemble.rules:
        if all((values[ensemble.features[f]] > cut) == above for f, above, cut in rule):
            total += weight
    return 1 / (1 + math.exp(-total))


def test_quality_stage_keeps_what_the_rules_accept(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    ensemble = quality.train(docs, labels, fold(3) != 1)
    assert ensemble.rules
    scores = {r.doc_id: plain_score(ensemble, r) for r in quality.statistics(docs, ["doc_id"]).collect()}
    got = {r.doc_id: r.score for r in quality.quality_scores(docs, labels).collect()}
    assert got == pytest.approx(scores)
    kept = {r.doc_id for r in corpus_pipeline.good(spark, docs, sf_dir).collect()}
    assert kept == {i for i, s in scores.items() if s >= 0.5} and 0 < len(kept) < len(scores)


def test_decoding_chooses_the_least_loss():
    rng = np.random.default_rng(4)
    names = ["aa", "bb", "cc", "dd"]
    model = language_id.OutputCodes.fit(names, rng.integers(0, 50, (4, 1 << 10)).astype(float))
    texts = ["some words here", "xyz", "", None, "123", "é ü", "word " * 300]
    langs, scores, unsure = model.predict(texts)
    for text, lang, score, flag in zip(texts, langs, scores, unsure, strict=True):
        if not text or text == "123":
            assert (lang, score, flag) == ("und", 0, False)
            continue
        counts = language_id.grams(text, 1 << 10)
        margins = [sum(float(counts[k]) * float(model.weights[k, b]) for k in np.flatnonzero(counts)) / math.sqrt(counts.sum()) for b in range(model.codes.shape[1])]
        losses = [sum(math.log1p(math.exp(-c * m)) for c, m in zip(code, margins, strict=True)) for code in model.codes]
        odds = [math.exp(min(losses) - x) for x in losses]
        best = int(np.argmin(losses))
        share = sorted((o / sum(odds) for o in odds), reverse=True)
        assert lang == names[best] and score == pytest.approx(share[0], rel=1e-4)
        assert flag == (share[0] - share[1] < language_id.MARGIN)


def test_mix_stage_repeats_documents_as_the_mix_takes_them(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    want = Counter()
    for r in mixing.mix(docs).collect():
        epochs = int(r.target) // r.source_size if r.source_size else 0
        want[r.doc_id] += max(1, epochs) if r.size == 0 else (2 * r.taken + r.size) // (2 * r.size)
    got = Counter(r.doc_id for r in corpus_pipeline.mixed(spark, docs, sf_dir).collect())
    assert got == +want


def test_packing_stage_places_every_piece_once(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").filter("doc_id < 120")
    twice = docs.unionAll(docs.filter("doc_id % 3 = 0"))
    encoder = packing.Encoder(packing.tokenizer_path())
    want = Counter()
    for r in twice.collect():
        ids = np.array(encoder.tokenizer.encode(r.text or "", add_special_tokens=False).ids + [0], dtype="<u4")
        first = len(ids) % 2048 or 2048
        for start, end in zip([0, *range(first, len(ids), 2048)], [*range(first, len(ids) + 1, 2048)], strict=False):
            want[r.doc_id, start, end - start, zlib.crc32(ids[start:end].tobytes())] += 1
    rows = corpus_pipeline.packed(spark, twice, sf_dir).collect()
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32) for r in rows) == want
    places = Counter()
    for r in rows:
        for at in range(r.offset, r.offset + r.length, 64):
            places[r.sequence_id, at] += 1
    assert max(places.values()) == 1 and max(r.offset + r.length for r in rows) <= 2048


def test_whole_run_is_the_stages_in_turn(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    counts = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        counts.append(docs.count())
    assert counts[0] >= counts[1] >= counts[2] >= counts[3] > 0
    final = corpus_pipeline.run(spark, sf_dir)
    assert final.filter("start = 0").count() == counts[4]
    assert final.agg(F.sum("length")).first()[0] > 0


def test_the_mix_orders_few_documents_whatever_their_weight(spark, monkeypatch):
    """Words of 43 letters have the least weight; their ranges are as even as others', and the cut is that of a full sort."""
    rows = [(i, " ".join(["w" * 43] * (1 + i % 5)), "long") for i in range(6000)] + [(i, "short words " * (1 + i % 3), "plain") for i in range(6000, 9000)]
    keys = mixing.keyed(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    place = keys.groupBy("source", mixing.step(mixing.spot(F.col("key"))).alias("p")).count()
    assert place.agg(F.max("count")).first()[0] < 25
    monkeypatch.setattr(mixing, "KEY_RANGES", 16)  # many documents in a range and a part of it
    got = {r.plan_source: r for r in mixing.plan(keys).collect()}
    for source in ("long", "plain"):
        own = sorted((r.key, r.doc_id, r["size"]) for r in keys.filter(F.col("source") == source).collect())
        left = math.floor(got[source].target) - got[source].epochs * sum(n for _, _, n in own)
        for key, doc_id, n in own:
            if left < n:
                break
            left -= n
        assert (got[source].cut_key, got[source].cut_id, got[source].cut_words) == (key, doc_id, left)
