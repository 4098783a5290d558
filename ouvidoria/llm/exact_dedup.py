"""Exact dedup by a persistent digest index.

The index is a table bucketed and sorted by the digest of the normalised text. A batch is reduced to its distinct
digests, those already in the index are removed by a sort-merge anti-join, and the rest is appended. Digests are found
once per document and staged, so later steps move 40 bytes a document and never the text.

Defined results: null text is the empty text; rows that repeat a doc_id keep it together; documents whose ids are all
null within a group have a null keep_id and are kept; an empty batch leaves the index as it is.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ouvidoria.llm.common import SPACES, partitions, staged, text_or_empty, whole_row
from ouvidoria.session import scratch_path


def digest_column() -> Column:
    """SHA-256 (32 bytes) of the text with white-space runs as one space."""
    return F.unhex(F.sha2(F.regexp_replace(text_or_empty(), SPACES, " "), 256))


def digests(docs: DataFrame) -> DataFrame:
    """doc_id and the digest of the text."""
    return docs.select("doc_id", digest_column().alias("digest"))


class DigestIndex:
    """Table (digest, keep_id), bucketed and sorted by digest, one row per distinct text ever seen."""

    def __init__(self, spark: SparkSession, name: str, path: str, buckets: int):
        self.spark, self.name, self.path, self.buckets = spark, name, path, buckets
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} (digest BINARY, keep_id BIGINT) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'"
        )

    @classmethod
    def temporary(cls, spark: SparkSession) -> DigestIndex:
        """A fresh index in the shared folder, with as many buckets as a shuffle has partitions."""
        name = f"digest_index_{uuid.uuid4().hex}"
        return cls(spark, name, scratch_path(spark, "digest-index"), partitions(spark))

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def append(self, groups: DataFrame) -> None:
        """Add the digests of ``groups`` (digest, keep_id; one row each) that the index lacks.

        A batch that is appended twice, or again after a crash, adds nothing the second time.
        """
        new = staged(groups.join(self.table().hint("merge"), "digest", "left_anti"), "new-digests")
        (
            new.select("digest", "keep_id")
            .repartition(self.buckets, "digest")
            .sortWithinPartitions("digest")
            .write.format("parquet")
            .mode("append")
            .bucketBy(self.buckets, "digest")
            .sortBy("digest")
            .option("path", self.path)
            .saveAsTable(self.name)
        )
        self.spark.catalog.refreshTable(self.name)


def deduplicate(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """doc_id, keep_id, group_size, kept, digest for every row of a batch.

    Without an index a fresh one is used. With one, texts of earlier batches win over the batch's own documents;
    ``group_size`` counts the batch.
    """
    index = index or DigestIndex.temporary(docs.sparkSession)
    rows = staged(digests(docs), "digests")
    groups = staged(
        rows.groupBy("digest").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")), "groups"
    )
    index.append(groups)
    # Written out so that the join below has a plain exchange on both sides: its hot digests can then be split.
    found = staged(groups.drop("keep_id").join(index.table().hint("merge"), "digest"), "resolved")
    return rows.join(found.hint("merge"), "digest").select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "digest",
    )


def _least_row(docs: DataFrame) -> Column:
    """The least of several rows by their columns; maps, which have no order, go by their text."""
    maps = [c for c, kind in docs.dtypes if "map<" in kind or kind == "variant"]
    if not maps:
        return F.min("row")
    parts = [F.to_json(F.struct(F.col("row").getField(c))) if c in maps else F.col("row").getField(c) for c in docs.columns]
    return F.min_by("row", F.struct(*parts))


def rows_at(docs: DataFrame, places: DataFrame) -> DataFrame:
    """One row of ``docs``, with all its columns, for each of ``places`` (digest, stay): of that text and that id.

    Rows meet by text and id together, so copies of one text that do not stay are spread by their ids. Of rows that share
    both the least by its columns stays.
    """
    rows = docs.select(
        whole_row(docs),
        digest_column().alias("of"),
        F.col("doc_id").isNull().alias("nameless"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"),
    )
    wanted = places.select(F.col("digest").alias("of"), F.col("stay").isNull().alias("nameless"), F.coalesce("stay", F.lit(0)).alias("id"))
    keys = ["of", "nameless", "id"]
    chosen = rows.join(wanted.hint("merge"), keys, "left_semi").groupBy(*keys).agg(_least_row(docs).alias("row"))
    return chosen.select("row.*")


def distinct_documents(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """One row of ``docs`` for every distinct text that stays, with all its columns: a row of the text's keep_id.

    Rows are chosen by text and id together, so neither rows without an id nor repeats of an id stand for each other.
    """
    stay = deduplicate(docs, index).filter("kept").select("digest", F.col("doc_id").alias("stay")).distinct()
    return rows_at(docs, staged(stay, "stay"))
