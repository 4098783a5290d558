"""Registered queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from ouvidoria.llm import (
    centroids,
    decontaminate,
    exact_dedup,
    language_id,
    mixing,
    packing,
    phrases,
    quality,
    repair,
    simhash,
    sql,
    suffix_tree,
    topk,
    toxicity,
)
from ouvidoria.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.filter(F.col("vec_id") % 100 == 0))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.deduplicate(table(spark, sf_dir, "documents"))
    return found.withColumn("text_sha256", F.lower(F.hex("digest"))).drop("digest")


def op3_language_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("source")


def op6_repeated_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = phrases.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op7_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.lm_scores(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit_sequences(table(spark, sf_dir, "documents"))


def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clusters(table(spark, sf_dir, "embeddings"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.reports(repair.damaged(table(spark, sf_dir, "conversations")), F.col("copies"))


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def registered() -> dict[str, Query]:
    queries = [
        op1_exact_topk,
        op2_exact_dedup,
        op3_language_codes,
        op4_quality_rules,
        op5_source_mix,
        op6_repeated_phrases,
        op7_suffix_tree,
        op8_toxicity,
        op9_simhash,
        op10_best_fit_packing,
        op11_centroid_clusters,
        op12_conversation_repair,
        op13_decontamination,
    ]
    return {q.__name__: q for q in queries} | {"pipeline": corpus_pipeline.run}


_TOP_K = """
WITH whole AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, w.vec_id, CAST(list_inner_product(q.v, w.v) AS BIGINT) AS score
    FROM whole q JOIN whole w ON q.vec_id <> w.vec_id WHERE q.vec_id % 100 = 0
), ranked AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
        vec_id, score
    FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

_EXACT_DEDUP = r"""
WITH hashed AS (
    SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
    doc_id IS NOT DISTINCT FROM min(doc_id) OVER g AS kept, text_sha256
FROM hashed WINDOW g AS (PARTITION BY text_sha256)
"""

_MIX = r"""
WITH measured AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
        length(coalesce(text, '')) AS chars
    FROM documents
), keyed AS (
    SELECT doc_id, source, size,
        -ln((CAST(('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13)) AS BIGINT) + 0.5::DOUBLE)
            / 4503599627370496.0::DOUBLE)
        / greatest(0.1::DOUBLE, 1.0::DOUBLE
            / (1.0::DOUBLE + abs(chars::DOUBLE / greatest(size, 1)::DOUBLE - 7.0::DOUBLE) / 4.0::DOUBLE)) AS key
    FROM measured
), sizes AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
        [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][(row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1] AS w
    FROM keyed GROUP BY source
), levels AS (
    SELECT source, source_size, w, 2.0::DOUBLE * source_size AS stop,
        (1.5::DOUBLE * sum(source_size) OVER ()
            - coalesce(sum(2.0::DOUBLE * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM sizes WINDOW o AS (ORDER BY 2.0::DOUBLE * source_size / w, source ASC NULLS LAST)
), aims AS (
    SELECT source, source_size, least(stop, coalesce(
        (SELECT level FROM levels WHERE level <= stop / w ORDER BY stop / w, source ASC NULLS LAST LIMIT 1) * w, stop)) AS target
    FROM levels
), budgets AS (
    SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target) AS BIGINT) // source_size ELSE 0 END AS epochs FROM aims
), ordered AS (
    SELECT k.doc_id, k.size, b.source_size, b.target, b.epochs,
        CAST(floor(b.target) AS BIGINT) - b.epochs * b.source_size
            - (sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id) - k.size) AS open
    FROM keyed k JOIN budgets b ON k.source IS NOT DISTINCT FROM b.source
)
SELECT doc_id, size, source_size, target, CAST(epochs * size + greatest(0, least(size, open)) AS BIGINT) AS taken
FROM ordered
"""

_REPEATS = r"""
WITH w AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), p AS (
    SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w
), g AS (
    SELECT doc_id, i, min(doc_id) OVER (PARTITION BY md5(array_to_string(ws[i:i+49], ' '))) AS first FROM p
), covered AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS j FROM g WHERE first < doc_id
), words AS (
    SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS j FROM w
), kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY j) AS kept FROM words ANTI JOIN covered USING (doc_id, j) GROUP BY doc_id
), removed AS (
    SELECT doc_id, count(*) AS n FROM covered GROUP BY doc_id
)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
    sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id) LEFT JOIN removed USING (doc_id)
"""


def statements() -> dict[str, str]:
    return {
        "op1_exact_topk": _TOP_K,
        "op2_exact_dedup": _EXACT_DEDUP,
        "op5_source_mix": _MIX,
        "op6_repeated_phrases": _REPEATS,
        "op11_centroid_clusters": sql.centroids(),
        "op12_conversation_repair": sql.repairs(),
        "op13_decontamination": sql.leaks(),
    }
