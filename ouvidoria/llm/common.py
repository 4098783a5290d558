"""Helpers of the corpus operators: tables, folds, words, staged results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ouvidoria.session import scratch_path

# A word is a run of anything but these six white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def fold(divisor: int, doc_id: str = "doc_id") -> Column:
    """Remainder of the checksum of the id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % divisor


def named(column: str) -> Column:
    """A column by its name as it is, dots and all."""
    return F.col("`" + column.replace("`", "``") + "`")


def whole_row(df: DataFrame) -> Column:
    return F.struct(*[named(c) for c in df.columns]).alias("row")


def staged(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write a table to the shared folder and read it again: computed once, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    squeezed = {} if compression is None else {"compression": compression, "parquet.compression.codec.zstd.level": "1"}
    df.write.options(**squeezed).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
