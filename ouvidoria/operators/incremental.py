"""High-water mark, page frontier and the gate of the daily feed."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ouvidoria.functions.dates import br_timestamp
from ouvidoria.session import path_exists

# Fixed value: text form of the stored mark.
MARK_FORMAT = "%d/%m/%Y %H:%M:%S"


def current_mark(pages: DataFrame, since: str = "page_ts") -> Column:
    """Counter of the newest page, as a scalar subquery."""
    return pages.agg(F.max(since)).scalar()


def _mark_column(mark: datetime | str | None) -> Column:
    text = mark.isoformat(sep=" ") if isinstance(mark, datetime) else mark
    return F.lit(text).cast("timestamp_ntz")


def frontier(df: DataFrame, mark: datetime | str | None, since: str = "page_ts") -> DataFrame:
    """Rows of all pages newer than the mark, plus the first page at or below it.

    If no page is that old every row is kept; without a mark only the newest page is. The bound is
    one scalar aggregate over the counter column: no global ordering, no collected pages.
    """
    if mark is None:
        bound = current_mark(df, since)
    else:
        reached = F.max(F.when(F.col(since) <= _mark_column(mark), F.col(since)))
        bound = df.agg(F.coalesce(reached, F.min(since))).scalar()
    return df.where(F.col(since) >= bound)


def newer_than(df: DataFrame, mark: datetime | str | None, ts: str = "ts") -> DataFrame:
    """Record-level form of the frontier: only what is newer than the mark, so loads never overlap."""
    return df if mark is None else df.where(F.col(ts) > _mark_column(mark))


def gate(df: DataFrame, mark: datetime | str | None, current: Column) -> DataFrame:
    """All rows if the feed moved past the mark, else none; a first run emits nothing."""
    return df.where(F.lit(False) if mark is None else current > _mark_column(mark))


@dataclass(frozen=True)
class MarkStore:
    """The mark as an append-only log; its newest entry counts.

    Nothing is overwritten, so a crash between two steps never loses the mark.
    """

    spark: SparkSession
    path: str

    def read(self) -> datetime | None:
        if not path_exists(self.spark, self.path):
            return None
        return self.spark.read.text(self.path).agg(F.max(br_timestamp(F.trim("value")))).first()[0]

    def write(self, mark: datetime) -> None:
        fraction = f".{mark.microsecond:06d}" if mark.microsecond else ""
        line = self.spark.range(1).select(F.lit(mark.strftime(MARK_FORMAT) + fraction).alias("value"))
        line.write.mode("append").text(self.path)


def run_increment(
    records: DataFrame, store: MarkStore, sink: Callable[[DataFrame], None], record_level: bool = True
) -> bool:
    """One run over records with ``page_ts`` (and ``ts``): emit what is new, then advance the mark.

    The first run only stores the mark. Returns whether anything was handed to ``sink``. By records
    the mark is the newest record's time, and nothing comes twice; by pages it is the newest page's
    counter, and the page at the old mark comes again.
    """
    mark = store.read()
    current = records.agg(F.max("ts" if record_level else "page_ts")).first()[0]
    if current is None or (mark is not None and current <= mark):
        return False
    if mark is not None:
        sink(newer_than(records, mark) if record_level else frontier(records, mark))
    store.write(current)
    return mark is not None
