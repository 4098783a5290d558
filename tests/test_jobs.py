from datetime import date

import pytest

from ouvidoria import jobs
from ouvidoria import schemas as S
from ouvidoria.functions.dates import scheduled_ref
from ouvidoria.plans.fixtures import complaints_daily, complaints_monthly
from ouvidoria.sources import feeds
from ouvidoria.sources.tables import Warehouse


def test_scheduled_refs():
    assert scheduled_ref("monthly", date(2026, 3, 15)) == "2026-02"
    assert scheduled_ref("daily", date(2026, 3, 5), " ") == "20260305"
    assert scheduled_ref("daily", date(2026, 3, 5), "20200101") == "20200101"


def test_jobs_by_name_give_the_same_golds_as_the_joint_ones(spark, sf_dir, tmp_path, rows):
    landing, base, prefix = str(tmp_path / "dev-in"), str(tmp_path / "dev-lake"), "jobs_"
    month, day = "1996-03", "20240110"
    feeds.write_feed(complaints_monthly(spark, sf_dir).where(f"datrefcarga = '{month}'"),
                     f"{landing}/basecompleta{month}.csv", S.MONTHLY_FIELDS, feeds.MONTHLY_SEP, null_text=None)
    feeds.write_feed(complaints_daily(spark, sf_dir).where(f"datrefcarga = '{day}'"),
                     f"{landing}/reclamacoes_{day}.csv", S.DAILY_FIELDS, feeds.DAILY_SEP, null_text=None)

    def job(name, ref=None, *more):
        argv = [name, "--env", "dev", "--base", str(tmp_path / "{env}-lake"), "--landing", str(tmp_path / "{env}-in"),
                "--prefix", prefix, *(["--ref", ref] if ref else []), *more]
        jobs.run(spark, argv)

    job("create_tables")
    for name, ref in [("bronze", month), ("bronze_daily", day), ("silver", month), ("silver_ai", day),
                      ("golds_monthly", month), ("golds_daily", day)]:
        job(name, ref)
    wh = Warehouse(spark, base, prefix)
    joint = {t.name: rows(wh.table(t)) for t in S.GOLD_TABLES}
    assert all(joint.values())
    for spec in S.GOLD_TABLES:
        job(f"gold_{spec.name}", day if spec.name.startswith("ai_") else month)
    assert {t.name: rows(wh.table(t)) for t in S.GOLD_TABLES} == joint
    with pytest.raises(ValueError):
        job("silver")
    job("drop_tables")
    assert not spark.catalog.databaseExists(f"{prefix}g_consumidor")
