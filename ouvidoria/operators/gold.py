"""The eight aggregates. Each groups by slice, so one call serves one slice or all of them.

Every aggregate combines partially before its shuffle, so a bank with a third of all rows
sends one row per task. Sums and counts are integers: results do not depend on row order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ouvidoria.functions.text import digits_only, region_key
from ouvidoria.schemas import SLICE_KEY

NAME = "nomefantasia"


def ratio(total: Column, n: Column, digits: int) -> Column:
    """Sum over count, rounded half up. Not ``avg``: rows without a value stay in ``n``."""
    return F.round(total / n, digits)


def grupo_problema(silver: DataFrame) -> DataFrame:
    return silver.groupBy(NAME, "grupoproblema", SLICE_KEY).agg(F.count(NAME).alias("qtdreclamcoes"))


def media_avaliacao(silver: DataFrame) -> DataFrame:
    return (
        silver.where(F.col("notaconsumidor").isNotNull())
        .groupBy(NAME, SLICE_KEY)
        .agg(ratio(F.sum("notaconsumidor"), F.count(NAME), 2).alias("mediaAvaliacao"))
    )


def media_resposta(silver: DataFrame) -> DataFrame:
    return (
        silver.where(F.col("respondida"))
        .groupBy(NAME, SLICE_KEY)
        .agg(ratio(F.sum("temporesposta"), F.count(NAME), 0).alias("mediaRespostaDias"))
    )


def top_per_slice(counts: DataFrame, measure: str, k: int = 10) -> DataFrame:
    """The ``k`` biggest per slice, ties by name.

    The rank filter lets each task cut its part to ``k`` rows per slice before the shuffle.
    """
    order = Window.partitionBy(SLICE_KEY).orderBy(F.col(measure).desc(), F.col(NAME).asc())
    return counts.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= k).drop("_rank")


def reclamacao_top_ten(silver: DataFrame, k: int = 10) -> DataFrame:
    counts = silver.groupBy(NAME, SLICE_KEY).agg(F.count(NAME).alias("qtdreclamcoes"))
    return top_per_slice(counts, "qtdreclamcoes", k)


def reclamacao_top_ten_of(silver: DataFrame, ref: str, k: int = 10) -> DataFrame:
    """The same for one slice, as a plain top-k."""
    return (
        silver.where(F.col(SLICE_KEY) == ref)
        .groupBy(NAME, SLICE_KEY)
        .agg(F.count(NAME).alias("qtdreclamcoes"))
        .orderBy(F.col("qtdreclamcoes").desc(), F.col(NAME).asc())
        .limit(k)
    )


def reclamacao_uf(silver: DataFrame) -> DataFrame:
    return (
        silver.groupBy(NAME, region_key(F.col("uf")).alias("uf"), SLICE_KEY)
        .agg(F.count(NAME).alias("qtdReclamcoesUf"))
        .select(NAME, "uf", SLICE_KEY, "qtdReclamcoesUf")
    )


def ai_status(classified: DataFrame) -> DataFrame:
    return classified.groupBy("status", "dataocorrido", SLICE_KEY).agg(F.count("*").alias("qtd"))


def ai_nota(classified: DataFrame) -> DataFrame:
    return (
        classified.groupBy(digits_only(F.col("nota")).alias("nota"), "dataocorrido", SLICE_KEY)
        .agg(F.count("*").alias("qtd"))
        .select("nota", "dataocorrido", SLICE_KEY, "qtd")
    )


def ai_macro_categoria(classified: DataFrame) -> DataFrame:
    return classified.groupBy("macro_categoria", "dataocorrido", SLICE_KEY).agg(F.count("*").alias("qtd"))


# -- one pass for all golds of a feed ---------------------------------------------------------


def monthly_rollup(silver: DataFrame) -> DataFrame:
    """Additive parts of the five monthly golds at their common grain, in one scan and shuffle."""
    rated, answered = F.col("notaconsumidor").isNotNull(), F.col("respondida")
    return silver.groupBy(NAME, "grupoproblema", "uf", SLICE_KEY).agg(
        F.count(NAME).alias("n"),
        F.count_if(rated).alias("n_rated"),
        F.sum("notaconsumidor").alias("sum_score"),
        F.count_if(answered).alias("n_answered"),
        F.sum(F.when(answered, F.col("temporesposta"))).alias("sum_days"),
    )


def monthly_golds(rollup: DataFrame) -> dict[str, DataFrame]:
    """The five monthly golds from ``monthly_rollup``, keyed by table name."""
    by_bank = rollup.groupBy(NAME, SLICE_KEY)

    def count_by(*keys: Column | str, alias: str) -> DataFrame:
        return rollup.groupBy(*keys).agg(F.sum("n").alias(alias))

    return {
        "grupoproblema": count_by(NAME, "grupoproblema", SLICE_KEY, alias="qtdreclamcoes"),
        "mediaavaliacao": by_bank.agg(
            ratio(F.sum("sum_score"), F.sum("n_rated"), 2).alias("mediaAvaliacao"),
            F.sum("n_rated").alias("_n"),
        ).where("_n > 0").drop("_n"),
        "mediaresposta": by_bank.agg(
            ratio(F.sum("sum_days"), F.sum("n_answered"), 0).alias("mediaRespostaDias"),
            F.sum("n_answered").alias("_n"),
        ).where("_n > 0").drop("_n"),
        "reclamacaotopten": top_per_slice(count_by(NAME, SLICE_KEY, alias="qtdreclamcoes"), "qtdreclamcoes"),
        "reclamacaouf": count_by(
            NAME, region_key(F.col("uf")).alias("uf"), SLICE_KEY, alias="qtdReclamcoesUf"
        ),
    }


def daily_rollup(classified: DataFrame) -> DataFrame:
    """Counts at the common grain of the three daily golds."""
    return classified.groupBy(
        "status", digits_only(F.col("nota")).alias("nota"), "macro_categoria", "dataocorrido", SLICE_KEY
    ).agg(F.count("*").alias("n"))


def daily_golds(rollup: DataFrame) -> dict[str, DataFrame]:
    def count_by(key: str) -> DataFrame:
        return rollup.groupBy(key, "dataocorrido", SLICE_KEY).agg(F.sum("n").alias("qtd"))

    return {
        "ai_status": count_by("status"),
        "ai_nota": count_by("nota"),
        "ai_macro_categoria": count_by("macro_categoria"),
    }
