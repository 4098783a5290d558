"""Bronze to gold for both feeds, for one load or for a backfill of many."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ouvidoria import schemas as S
from ouvidoria.operators import classify, conform, gold, scoring
from ouvidoria.session import cut_lineage, require_ref
from ouvidoria.sources import feeds
from ouvidoria.sources.commit import Commits
from ouvidoria.sources.tables import Warehouse

_MONTHLY_GOLDS = {t.name: t for t in (S.GOLD_PROBLEMA, S.GOLD_AVALIACAO, S.GOLD_RESPOSTA, S.GOLD_TOP_TEN, S.GOLD_UF)}
_DAILY_GOLDS = {t.name: t for t in (S.GOLD_STATUS, S.GOLD_NOTA, S.GOLD_MACRO)}

_SINGLE_GOLDS = {
    "grupoproblema": (S.SILVER_MONTHLY, gold.grupo_problema),
    "mediaavaliacao": (S.SILVER_MONTHLY, gold.media_avaliacao),
    "mediaresposta": (S.SILVER_MONTHLY, gold.media_resposta),
    "reclamacaouf": (S.SILVER_MONTHLY, gold.reclamacao_uf),
    "ai_status": (S.SILVER_DAILY, gold.ai_status),
    "ai_nota": (S.SILVER_DAILY, gold.ai_nota),
    "ai_macro_categoria": (S.SILVER_DAILY, gold.ai_macro_categoria),
}

Refs = str | Iterable[str] | None


def _scope(df: DataFrame, refs: Refs) -> DataFrame:
    if refs is None:
        return df
    wanted = [require_ref(r) for r in ([refs] if isinstance(refs, str) else refs)]
    return df.where(F.col(S.SLICE_KEY).isin(wanted))


def load_bronze_monthly(wh: Warehouse, root: str, ref: str, multi_line: bool = False) -> None:
    """One monthly load from ``basecompleta{ref}*.csv`` under ``root``."""
    df = feeds.read_monthly(wh.spark, feeds.monthly_path(root, ref), multi_line)
    wh.replace(S.BRONZE_MONTHLY, feeds.with_slice(df, ref), ref)


def load_bronze_daily(wh: Warehouse, root: str, ref: str) -> None:
    """One daily load from ``reclamacoes_{ref}.csv`` under ``root``."""
    df = feeds.read_daily(wh.spark, feeds.daily_path(root, ref))
    wh.replace(S.BRONZE_DAILY, feeds.with_slice(df, ref), ref, rebalance=True)


def build_silver_monthly(wh: Warehouse, refs: Refs = None) -> None:
    """Few bronze rows pass the filter, hence the rebalancing: five golds read these files."""
    bronze = _scope(wh.table(S.BRONZE_MONTHLY), refs)
    wh.replace(S.SILVER_MONTHLY, conform.silver_monthly(bronze), refs, rebalance=True)


def build_silver_with_rejects(wh: Warehouse, refs: Refs, rejects_path: str) -> dict[str, int]:
    """Silver, and beside it a table of what did not parse, from one scan of bronze. Returns the metrics of the load.

    Typed rows and rejects are staged together; both tables are written from there. A load's rejects are replaced with it.
    """
    rows = conform.financial_banks(_scope(wh.table(S.BRONZE_MONTHLY), refs))
    metrics = Observation("conformance")
    staged = cut_lineage(conform.counted(conform.conform_with_rejects(rows), metrics))
    wh.replace(S.SILVER_MONTHLY, staged.drop("rejects"), refs, rebalance=True)
    found = conform.rejects(staged).groupBy("column", "value", S.SLICE_KEY).agg(F.count("*").alias("n"))
    writer = found.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(S.SLICE_KEY)
    writer.parquet(rejects_path)
    return metrics.get


def build_silver_daily(
    wh: Warehouse,
    refs: Refs = None,
    institution: str = "Santander",
    append: bool = False,
    answer: scoring.Answer | None = None,
    model: str | None = None,
    rebalance: bool = True,
) -> None:
    """Classified narratives of one institution, by the lexicon or by ``answer(prompts, model)``.

    Bronze files are cut by slice, so without ``rebalance`` no text is shuffled; with it few files come of few rows.
    """
    rows = conform.of_institution(_scope(wh.table(S.BRONZE_DAILY), refs), institution)
    if answer is None:
        rows = classify.classified_daily(rows)
    else:
        rows = scoring.classified_daily_by_model(rows, answer, model)
    if append:
        wh.append(S.SILVER_DAILY, rows)
    else:
        wh.replace(S.SILVER_DAILY, rows, refs, rebalance=rebalance)


def _build_golds(wh: Warehouse, rollup: DataFrame, golds, tables: dict[str, S.TableSpec], refs: Refs) -> None:
    """The rollup holds group counts only; it is kept while the golds are written from it.

    It is filled before the writes start side by side, so that silver is scanned once. An executor
    lost meanwhile costs a recomputation of its part, not the run.
    """
    rollup = rollup.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rollup.count()
        wh.replace_many({tables[name]: df for name, df in golds(rollup).items()}, refs)
    finally:
        rollup.unpersist()


def build_gold_monthly(wh: Warehouse, refs: Refs = None) -> None:
    """Five golds from one scan of silver."""
    silver = _scope(wh.table(S.SILVER_MONTHLY), refs)
    _build_golds(wh, gold.monthly_rollup(silver), gold.monthly_golds, _MONTHLY_GOLDS, refs)


def build_gold_daily(wh: Warehouse, refs: Refs = None) -> None:
    """Three golds from one scan of silver."""
    silver = _scope(wh.table(S.SILVER_DAILY), refs)
    _build_golds(wh, gold.daily_rollup(silver), gold.daily_golds, _DAILY_GOLDS, refs)


def publish_monthly(wh: Warehouse, refs: Refs = None) -> dict[str, list[str]]:
    """Silver and its five golds of these loads as one commit: readers of the finished catalog see all of it or none."""
    silver = conform.silver_monthly(_scope(wh.table(S.BRONZE_MONTHLY), refs))
    return _publish(wh, S.SILVER_MONTHLY, silver, gold.monthly_rollup, gold.monthly_golds, _MONTHLY_GOLDS, refs)


def publish_daily(wh: Warehouse, refs: Refs = None, institution: str = "Santander") -> dict[str, list[str]]:
    """The classified narratives and their three golds of these loads as one commit."""
    rows = conform.of_institution(_scope(wh.table(S.BRONZE_DAILY), refs), institution)
    return _publish(wh, S.SILVER_DAILY, classify.classified_daily(rows), gold.daily_rollup, gold.daily_golds, _DAILY_GOLDS, refs)


def _publish(wh: Warehouse, spec: S.TableSpec, silver: DataFrame, rollup, golds, tables, refs: Refs):
    """Golds are made from the staged silver rows, which are evaluated once."""
    commits = Commits(wh)
    with commits.open() as commit:
        staged = commit.stage({spec: silver}, refs)
        kept = rollup(staged[spec]).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            kept.count()
            commit.stage({tables[name]: df for name, df in golds(kept).items()}, refs)
        finally:
            kept.unpersist()
    return commit.slices


def build_one_gold(wh: Warehouse, table: str, ref: str) -> None:
    """A single gold of one load straight from silver."""
    if table == S.GOLD_TOP_TEN.name:
        source, aggregate = S.SILVER_MONTHLY, lambda df: gold.reclamacao_top_ten_of(df, ref)
    else:
        source, aggregate = _SINGLE_GOLDS[table]
    wh.replace({t.name: t for t in S.GOLD_TABLES}[table], aggregate(wh.slice(source, ref)), ref)


def run_monthly(wh: Warehouse, root: str, ref: str) -> None:
    load_bronze_monthly(wh, root, ref)
    build_silver_monthly(wh, ref)
    build_gold_monthly(wh, ref)


def run_daily(wh: Warehouse, root: str, ref: str, institution: str = "Santander") -> None:
    load_bronze_daily(wh, root, ref)
    build_silver_daily(wh, ref, institution)
    build_gold_daily(wh, ref)


def backfill_monthly(wh: Warehouse, bronze: DataFrame, refs: Refs = None, rebalance: bool | None = None) -> None:
    """Many loads at once: one job per table instead of one per load and table.

    Silver and gold get exactly the slices that bronze replaced, so a load whose rows all fail the filter is emptied.

    ``rebalance=False`` saves a shuffle of the whole feed when its files are cut by load already.
    """
    refs = wh.replace(S.BRONZE_MONTHLY, bronze, refs, rebalance)
    build_silver_monthly(wh, refs)
    build_gold_monthly(wh, refs)


def backfill_daily(
    wh: Warehouse,
    bronze: DataFrame,
    refs: Refs = None,
    institution: str = "Santander",
    rebalance: bool | None = None,
) -> None:
    refs = wh.replace(S.BRONZE_DAILY, bronze, refs, rebalance)
    build_silver_daily(wh, refs, institution, rebalance=rebalance is not False)
    build_gold_daily(wh, refs)
