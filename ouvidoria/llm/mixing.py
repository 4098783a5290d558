"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each document draws an exponential key, -ln(u) / w, with u from a hash of its id and w its quality weight; documents of
a source are taken in the order of their keys until the words of the source's budget are used up. Whole epochs come
first, the fractional selection fills the rest. A source is never sorted as a whole: keys are cut into ranges, words are
summed per range, the one range that holds the budget's end is cut and summed once more, and only the one part of it that
holds the end is ordered: about three in ``KEY_RANGES`` squared of a source's documents, at the least weight as at the
highest. So a source with a third of all rows costs no more per task than any other.

Defined results: null text has no words; null is a source of its own, after all others; rows that repeat a doc_id share
one key and are cut together, each by an equal share; without words every target is 0; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ouvidoria.llm.common import WORD, staged, text_or_empty, whole_row

# Weights of the sources in code-point order, repeating; the mix has SHARE times all words, a source CAP times its own.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2.0
KEY_RANGES = 4096


def size_column() -> Column:
    return F.regexp_count(text_or_empty(), F.lit(WORD)).cast("long")


def quality_weight(chars: Column, size: Column) -> Column:
    """From 0.1 to 1: documents whose words have ordinary lengths (about seven characters with the space) come first."""
    mean = chars.cast("double") / F.greatest(size, F.lit(1)).cast("double")
    return F.greatest(F.lit(0.1), F.lit(1.0) / (F.lit(1.0) + F.abs(mean - F.lit(7.0)) / F.lit(4.0)))


def key_column(doc_id: Column, weight: Column, seed: str) -> Column:
    """Exponential variate with rate ``weight`` from 52 bits of a hash of the id; reruns agree."""
    head = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))), 1, 13)
    uniform = (F.conv(head, 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(2**52))
    return -F.log(uniform) / weight


def keyed(docs: DataFrame, seed: str = "mix", weight: Column | None = None) -> DataFrame:
    """doc_id, source, size and key of every document."""
    measured = docs.select(
        "doc_id",
        F.col("source").alias("source"),
        size_column().alias("size"),
        F.length(text_or_empty()).alias("chars"),
        (weight if weight is not None else F.lit(None).cast("double")).alias("given"),
    )
    chosen = F.coalesce(F.col("given"), quality_weight(F.col("chars"), F.col("size")))
    return measured.select("doc_id", "source", "size", key_column(F.col("doc_id"), chosen, seed).alias("key"))


def targets(source_sizes: DataFrame, weights=WEIGHTS, share=SHARE, cap=CAP) -> DataFrame:
    """(source, source_size) -> with target: shares by weight, stopped at ``cap`` times the size, the excess reshared.

    Resharing until nothing is above its stop means one level per unit of weight for all sources that are not stopped.
    It is found with running sums over the sources in the order in which they reach their stops. One row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    wheel = F.array(*[F.lit(float(w)) for w in weights])
    stops = source_sizes.withColumn("n", F.row_number().over(by_name) - 1).select(
        "source",
        "source_size",
        F.element_at(wheel, (F.col("n") % len(weights)) + 1).alias("w"),
        (F.col("source_size").cast("double") * F.lit(float(cap))).alias("stop"),
    )
    order = Window.orderBy((F.col("stop") / F.col("w")), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    level = (
        F.lit(float(share)) * F.sum("source_size").over(whole).cast("double")
        - F.coalesce(F.sum("stop").over(before), F.lit(0.0))
    ) / F.sum("w").over(onward)
    levels = stops.select(
        "source", "source_size", "w", "stop", level.alias("level"), F.row_number().over(order).alias("i")
    )
    open_level = F.when(F.col("level") <= F.col("stop") / F.col("w"), F.struct("i", "level"))
    chosen = levels.withColumn("first", F.min(open_level).over(whole))
    reach = F.coalesce(F.col("first.level") * F.col("w"), F.col("stop"))
    return chosen.select("source", "source_size", F.least("stop", reach).alias("target"))


def spot(key: Column) -> Column:
    """Where a key lies among ``KEY_RANGES`` ranges, in order of keys.

    The steps are even for the mean of the lowest and the highest weight's distribution, so no weight between them has
    more than about three times its share in a range.
    """
    return (F.lit(2.0) - F.exp(-key) - F.exp(-key * F.lit(0.1))) * F.lit(KEY_RANGES / 2.0)


def step(place: Column) -> Column:
    return F.least(F.lit(KEY_RANGES - 1), F.floor(place)).cast("int")


def budget_ends(sums: DataFrame, goals: DataFrame, place: str) -> DataFrame:
    """(s, p, left): the place of a source in which its words reach ``rest``, and what is left of that before the place.

    ``sums`` has (source, place, words), ``goals`` (s, rest).
    """
    running = Window.partitionBy("source").orderBy(place)
    return (
        sums.select("source", place, "words", F.sum("words").over(running).alias("upto"))
        .join(goals, F.col("source").eqNullSafe(F.col("s")))
        .filter((F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("words") <= F.col("rest")))
        .select("s", F.col(place).alias("p"), (F.col("rest") - F.col("upto") + F.col("words")).alias("left"))
    )


def plan(rows: DataFrame, **options) -> DataFrame:
    """One row per source: target, epochs, and where in the order of keys the fractional selection ends.

    Documents before (cut_key, cut_id) are selected whole; those at it give ``cut_words`` words each.
    """
    placed = rows.withColumn("spot", spot(F.col("key"))).withColumn("place", step(F.col("spot")))
    placed = placed.withColumn("part", step((F.col("spot") - F.col("place")) * KEY_RANGES)).drop("spot")
    ranges = staged(placed.groupBy("source", "place").agg(F.sum("size").alias("words")), "mix-ranges")
    sums = ranges.groupBy("source").agg(F.sum("words").alias("source_size"))
    aims = staged(targets(sums, **options), "mix-targets").select(
        F.col("source").alias("s"),
        "source_size",
        "target",
        F.when(F.col("source_size") > 0, F.floor(F.floor("target") / F.col("source_size")))
        .otherwise(0)
        .cast("long")
        .alias("epochs"),
    )
    aims = aims.withColumn("rest", F.floor("target").cast("long") - F.col("epochs") * F.col("source_size"))
    same = F.col("source").eqNullSafe(F.col("s"))
    ends = staged(budget_ends(ranges, aims, "place"), "mix-ends")
    near = placed.join(ends.drop("left"), same & (F.col("place") == F.col("p"))).drop("s", "p")
    parts = staged(near.groupBy("source", "part").agg(F.sum("size").alias("words")), "mix-parts")
    finer = budget_ends(parts, ends.select("s", F.col("left").alias("rest")), "part")
    of = ends.select(F.col("s").alias("t"), F.col("p").alias("q"))
    finer = staged(finer.join(of, F.col("s").eqNullSafe(F.col("t"))).drop("t"), "mix-part-ends")
    units = (
        placed.join(finer, same & (F.col("place") == F.col("q")) & (F.col("part") == F.col("p")))
        .groupBy("source", "left", "key", "doc_id")
        .agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("copies"))
    )
    ordered = Window.partitionBy("source").orderBy("key", "doc_id")
    cuts = (
        units.withColumn("upto", F.sum("words").over(ordered))
        .filter((F.col("upto") > F.col("left")) & (F.col("upto") - F.col("words") <= F.col("left")))
        .select(
            F.col("source"),
            F.col("key").alias("cut_key"),
            F.col("doc_id").alias("cut_id"),
            F.floor((F.col("left") - F.col("upto") + F.col("words")) / F.col("copies")).alias("cut_words"),
        )
    )
    return staged(aims.join(cuts, same, "left").drop("source").withColumnRenamed("s", "plan_source"), "mix-plan")


def taken() -> Column:
    """Words that a mix takes of a document, repeats counted; over rows joined with their source's plan."""
    size = F.col("size")
    key, doc_id, cut_key, cut_id = (F.col(c) for c in ("key", "doc_id", "cut_key", "cut_id"))
    earlier = (key < cut_key) | ((key == cut_key) & (F.coalesce(doc_id < cut_id, doc_id.isNull() & cut_id.isNotNull())))
    at = (key == cut_key) & doc_id.eqNullSafe(cut_id)
    part = F.when(earlier, size).when(at, F.least(size, F.col("cut_words"))).otherwise(F.lit(0))
    return (F.col("epochs") * size + part).cast("long")


def mix(docs: DataFrame, seed: str = "mix", weight: Column | None = None, **options) -> DataFrame:
    """doc_id, source, size, source_size, target, taken of every document."""
    rows = staged(keyed(docs, seed, weight), "mix-keys")
    joined = rows.join(plan(rows, **options), F.col("source").eqNullSafe(F.col("plan_source")))
    return joined.select("doc_id", "source", "size", "source_size", "target", taken().alias("taken"))


def mixed_documents(docs: DataFrame, seed: str = "mix", **options) -> DataFrame:
    """The rows of ``docs`` with all their columns, each as often as the mix takes it whole.

    The document at which a source's budget ends is taken once more if at least half of it is within the budget.
    Only the plan, one row per source, is joined; texts aren't shuffled while the plan is small.
    """
    rows = staged(keyed(docs, seed), "mix-keys")
    chosen = plan(rows, **options)
    full = docs.select(whole_row(docs), "doc_id", "source", "text")
    measured = full.select(
        "row", "doc_id", "source", size_column().alias("size"), F.length(text_or_empty()).alias("chars")
    )
    key = key_column(F.col("doc_id"), quality_weight(F.col("chars"), F.col("size")), seed)
    joined = measured.withColumn("key", key).join(chosen, F.col("source").eqNullSafe(F.col("plan_source")))
    copies = F.floor((F.col("taken") * 2 + F.col("size")) / (F.greatest("size", F.lit(1)) * 2)).cast("int")
    # A document without words takes nothing from a budget; it comes as often as its source has whole epochs, at least once.
    copies = F.when(F.col("size") == 0, F.greatest(F.lit(1), F.col("epochs").cast("int"))).otherwise(copies)
    counted = joined.withColumn("taken", taken()).withColumn("copies", copies).filter("copies > 0")
    repeated = counted.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    return repeated.select("row.*")
