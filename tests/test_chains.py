import uuid

import pytest
from pyspark.sql import functions as F

from ouvidoria import schemas as S
from ouvidoria.operators import classify, conform, gold
from ouvidoria.plans import chains
from ouvidoria.plans.fixtures import complaints_daily, complaints_monthly
from ouvidoria.sources import feeds
from ouvidoria.sources.tables import Warehouse
from ouvidoria.streaming import daily_feed


@pytest.fixture
def wh(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"), f"c{uuid.uuid4().hex[:8]}_")
    warehouse.create()
    yield warehouse
    warehouse.drop()


def test_monthly_load_from_files(wh, spark, sf_dir, tmp_path, rows):
    month = complaints_monthly(spark, sf_dir).where("datrefcarga = '1996-03'")
    feeds.write_feed(month, str(tmp_path / "basecompleta1996-03_a.csv"), S.MONTHLY_FIELDS, feeds.MONTHLY_SEP, null_text=None)
    for _ in range(2):
        chains.run_monthly(wh, str(tmp_path), "1996-03")
    assert wh.slice(S.BRONZE_MONTHLY, "1996-03").count() == month.count()
    silver = conform.silver_monthly(month)
    assert rows(wh.table(S.SILVER_MONTHLY)) == rows(silver)
    assert rows(wh.table(S.GOLD_AVALIACAO)) == rows(S.GOLD_AVALIACAO.conform(gold.media_avaliacao(silver)))
    assert rows(wh.table(S.GOLD_TOP_TEN)) == rows(S.GOLD_TOP_TEN.conform(gold.reclamacao_top_ten(silver)))


def test_daily_load_from_files(wh, spark, sf_dir, tmp_path, rows):
    day = complaints_daily(spark, sf_dir).where("datrefcarga = '20240110'")
    path = feeds.daily_path(str(tmp_path), "20240110")
    feeds.write_feed(day, path, S.DAILY_FIELDS, feeds.DAILY_SEP, null_text=None)
    for _ in range(2):
        chains.run_daily(wh, str(tmp_path), "20240110")
    expected = classify.classified_daily(conform.of_institution(day))
    assert rows(wh.table(S.SILVER_DAILY)) == rows(S.SILVER_DAILY.conform(expected))
    assert rows(wh.table(S.GOLD_STATUS)) == rows(S.GOLD_STATUS.conform(gold.ai_status(expected)))
    chains.build_silver_daily(wh, "20240110", institution="Nubank")
    assert {r[0] for r in wh.table(S.SILVER_DAILY).select("nomeempresa").distinct().collect()} == {"Nubank"}


def test_backfill_equals_single_loads(wh, spark, sf_dir, rows):
    feed = complaints_monthly(spark, sf_dir)
    chains.backfill_monthly(wh, feed, rebalance=False)
    whole = {t.name: rows(wh.table(t)) for t in S.GOLD_TABLES[:5]}
    for ref in ("1995-02", "1999-12"):
        wh.replace(S.BRONZE_MONTHLY, feed.where(F.col(S.SLICE_KEY) == ref), ref)
        chains.build_silver_monthly(wh, ref)
        chains.build_gold_monthly(wh, ref)
    assert {t.name: rows(wh.table(t)) for t in S.GOLD_TABLES[:5]} == whole


def test_backfill_empties_slices_whose_rows_all_fail_the_filter(wh, spark, sf_dir):
    feed = complaints_monthly(spark, sf_dir).where("datrefcarga in ('1995-02', '1995-03')")
    chains.backfill_monthly(wh, feed)
    assert wh.slice(S.SILVER_MONTHLY, "1995-02").count() and wh.slice(S.GOLD_UF, "1995-02").count()
    chains.backfill_monthly(wh, feed.where("datrefcarga = '1995-02'").withColumn("area", F.lit("Telefonia")))
    for table in (S.SILVER_MONTHLY, *S.GOLD_TABLES[:5]):
        assert not wh.slice(table, "1995-02").count() and wh.slice(table, "1995-03").count()


def test_missing_reference_stops_a_job(wh, tmp_path):
    for job in (chains.run_monthly, chains.run_daily):
        with pytest.raises(ValueError):
            job(wh, str(tmp_path), "")


def write_day(root, ref, *narratives, name="part-0.csv"):
    folder = root / f"reclamacoes_{ref}.csv"
    folder.mkdir(parents=True, exist_ok=True)
    lines = ["|".join(S.DAILY_FIELDS)] + [f'Banco|s|t|d|c|SP|"{n}"|r|n|k' for n in narratives]
    (folder / name).write_text("\n".join(lines) + "\n", encoding="utf-8")


def test_stream_takes_each_file_once_and_reloads_changed_slices(wh, spark, tmp_path, rows):
    root, checkpoint = tmp_path / "feed", str(tmp_path / "cp")
    root.mkdir()

    def ingest():
        daily_feed.ingest_available(wh, str(root), checkpoint).awaitTermination()
        return rows(wh.table(S.BRONZE_DAILY).select("datrefcarga", "relato"))

    write_day(root, "20240101", "a\nb", "c")
    write_day(root, "20240102", "d")
    first = [("20240101", "a\nb"), ("20240101", "c"), ("20240102", "d")]
    assert ingest() == first
    assert ingest() == first
    write_day(root, "20240101", "tarde", name="part-1.csv")  # a late file of a loaded slice
    write_day(root, "20240103", "e")
    assert ingest() == sorted([*first, ("20240101", "tarde"), ("20240103", "e")], key=repr)
    write_day(root, "20240102", name="part-1.csv")  # header only: the slice keeps its other file
    assert ("20240102", "d") in ingest()


def test_stream_takes_a_day_that_is_written_again(wh, spark, tmp_path, rows):
    root, checkpoint = tmp_path / "feed", str(tmp_path / "cp")
    root.mkdir()
    loads = []

    def ingest():
        query = daily_feed.ingest_available(wh, str(root), checkpoint)
        query.awaitTermination()
        loads.append(sum(p.numInputRows for p in query.recentProgress))
        return rows(wh.table(S.BRONZE_DAILY).select("datrefcarga", "relato"))

    write_day(root, "20240101", "a", "b")
    write_day(root, "20240102", "c")
    ingest()
    write_day(root, "20240101", "corrigido")  # the same path
    assert ingest() == [("20240101", "corrigido"), ("20240102", "c")]
    kept = [f.stat().st_mtime_ns for f in sorted((tmp_path / "wh").rglob("*.parquet"))]
    assert ingest() == [("20240101", "corrigido"), ("20240102", "c")]
    assert loads == [2, 1, 0] and kept == [f.stat().st_mtime_ns for f in sorted((tmp_path / "wh").rglob("*.parquet"))]
    (root / "reclamacoes_20240102.csv" / "part-0.csv").unlink()  # landing zones get cleaned up
    assert ingest() == [("20240101", "corrigido"), ("20240102", "c")]
    ledger = daily_feed.FileLedger(spark, f"{checkpoint}/ledger")
    assert ledger.versions().count() == 3 and ledger.versions().select("path").distinct().count() == 2


def test_stream_finishes_what_a_crash_left(wh, spark, tmp_path, rows, monkeypatch):
    """The ledger is ahead of the table after the crash; the stream's checkpoint is not."""
    root, checkpoint = tmp_path / "feed", str(tmp_path / "cp")
    root.mkdir()
    write_day(root, "20240101", "a")
    daily_feed.ingest_available(wh, str(root), checkpoint).awaitTermination()
    write_day(root, "20240101", "nova", "versão")
    load = daily_feed.load_changed_slices

    def crash(*_):
        raise OSError("driver lost")

    monkeypatch.setattr(daily_feed, "load_changed_slices", crash)
    with pytest.raises(Exception, match="driver lost"):
        daily_feed.ingest_available(wh, str(root), checkpoint).awaitTermination()
    assert rows(wh.table(S.BRONZE_DAILY).select("relato")) == [("a",)]
    monkeypatch.setattr(daily_feed, "load_changed_slices", load)
    daily_feed.ingest_available(wh, str(root), checkpoint).awaitTermination()
    assert rows(wh.table(S.BRONZE_DAILY).select("relato")) == [("nova",), ("versão",)]


def test_ledger_lists_without_reading(spark, tmp_path, plan):
    write_day(tmp_path, "20240101", "a")
    ledger = daily_feed.FileLedger(spark, str(tmp_path / "ledger"))
    assert "ReadSchema: struct<path:string,modificationTime:timestamp,length:bigint>" in plan(ledger.listed(str(tmp_path)))
    assert ledger.take_up(str(tmp_path)) == 1 and ledger.take_up(str(tmp_path)) == 0


def test_delivered_days_keep_their_names(spark, sf_dir, tmp_path, rows):
    day = complaints_daily(spark, sf_dir).where("datrefcarga in ('20240110', '20240111')")
    for _ in range(2):
        feeds.deliver_days(day, str(tmp_path))
    names = sorted(str(p.relative_to(tmp_path)) for p in tmp_path.rglob("*.csv") if p.is_file())
    assert names == ["reclamacoes_20240110.csv/part-00000.csv", "reclamacoes_20240111.csv/part-00000.csv"]
    read = feeds.read_daily(spark, feeds.daily_path(str(tmp_path), "20240110"), feeds.NULL_TEXT)
    assert rows(read) == rows(day.where("datrefcarga = '20240110'").drop("datrefcarga"))


def test_stream_reads_a_single_file_per_slice(wh, spark, tmp_path):
    root = tmp_path / "feed"
    root.mkdir()
    (root / "reclamacoes_20240105.csv").write_text("|".join(S.DAILY_FIELDS) + "\nB|s|t|d|c|SP|x|r|n|k\n", encoding="utf-8")
    daily_feed.ingest_available(wh, str(root), str(tmp_path / "cp")).awaitTermination()
    assert wh.slice(S.BRONZE_DAILY, "20240105").count() == 1


def test_golds_scan_silver_once(wh, spark, sf_dir, plan):
    silver = wh.table(S.SILVER_MONTHLY)
    assert plan(gold.monthly_rollup(silver)).count("Scan parquet") == plan(silver.agg(F.count("*"))).count("Scan parquet")


def test_silver_with_rejects(wh, spark, sf_dir, tmp_path, rows):
    wh.replace(S.BRONZE_MONTHLY, complaints_monthly(spark, sf_dir))
    path = str(tmp_path / "rejects")
    for refs in (None, ["1996-03"]):
        metrics = chains.build_silver_with_rejects(wh, refs, path)
        silver = conform.silver_monthly(wh.table(S.BRONZE_MONTHLY))
        assert rows(wh.table(S.SILVER_MONTHLY)) == rows(silver)
        kept = spark.read.parquet(path)
        assert kept.agg(F.sum("n")).first()[0] == kept.where("column = 'dataabertura'").agg(F.sum("n")).first()[0] > 0
    assert metrics["rows"] == silver.where("datrefcarga = '1996-03'").count()
    assert metrics["rejected"] == metrics["dataabertura"] == (kept.where("datrefcarga = '1996-03'").agg(F.sum("n")).first()[0] or 0)
