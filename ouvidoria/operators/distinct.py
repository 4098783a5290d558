"""Exact distinct categories under any filter, from stored state: a distinct count is no sum, a union of bitmaps is one.

The state has one row per load and day: a bitmap of the taxonomy's categories that occur, and the few labels outside the
taxonomy, as a list. States of loads are put side by side, a load is replaced with its own rows, and a filter on loads or
days unites the rows that it leaves. Neither silver nor gold is read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ouvidoria.operators import taxonomy
from ouvidoria.schemas import SLICE_KEY

DAY = "dataocorrido"


def _number(label: Column) -> Column:
    """Place of a label in the taxonomy from one on; zero for others."""
    return F.array_position(F.array(*map(F.lit, taxonomy.MACROS)), label)


def category_state(rows: DataFrame, label: str = "macro_categoria") -> DataFrame:
    """(load, day, known, others) from rows with a load, a day and a label; null labels do not count."""
    number, c = _number(F.col(label)), F.col(label)
    # Days without a label go afterwards: a filter on labels before would be pushed down to where they are made, and
    # every text would be classified once for the filter and once more for the label.
    return rows.groupBy(SLICE_KEY, DAY).agg(
        F.bitmap_construct_agg(F.when(number > 0, F.bitmap_bit_position(number))).alias("known"),
        F.array_sort(F.collect_set(F.when(number == 0, c))).alias("others"),
        F.count(c).alias("_labels"),
    ).where("_labels > 0").drop("_labels")


def distinct_categories(state: DataFrame, output: str = "count_distinct_categorias") -> DataFrame:
    """How many different labels the rows of a (filtered) state have together."""
    known = F.coalesce(F.bitmap_count(F.bitmap_or_agg("known")), F.lit(0))
    others = F.size(F.array_distinct(F.flatten(F.collect_list("others"))))
    return state.agg((known + others).cast("bigint").alias(output))
