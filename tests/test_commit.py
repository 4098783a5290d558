"""Commits over several tables: whatever crashes where, slices are all old or all new after recovery."""

import uuid

import pytest
from pyspark.sql import functions as F

from ouvidoria import schemas as S
from ouvidoria.plans import chains
from ouvidoria.plans.fixtures import complaints_daily, complaints_monthly
from ouvidoria.sources.commit import Commit, Commits
from ouvidoria.sources.tables import Warehouse

TOP, UF = S.GOLD_TOP_TEN, S.GOLD_UF
REFS = [f"2024-0{m}" for m in range(1, 6)]


@pytest.fixture
def wh(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"), f"k{uuid.uuid4().hex[:8]}_")
    warehouse.create()
    yield warehouse
    warehouse.drop()


def frames(spark, n, refs=REFS):
    top = spark.createDataFrame([(n, "A", r) for r in refs], "qtdreclamcoes long, nomefantasia string, datrefcarga string")
    uf = top.select("nomefantasia", F.lit("Brasil - SP").alias("uf"), "datrefcarga", F.col("qtdreclamcoes").alias("qtdReclamcoesUf"))
    return {TOP: top, UF: uf}


def state(wh):
    """Number of each slice by table."""
    return {
        spec.name: {r[0]: r[1] for r in wh.table(spec).groupBy("datrefcarga").agg(F.max(spec.columns[-1][0])).collect()}
        for spec in (TOP, UF)
    }


def all_are(n, refs=REFS):
    return {spec.name: dict.fromkeys(refs, n) for spec in (TOP, UF)}


def test_replace_is_idempotent_and_leaves_other_slices(wh, spark):
    commits = Commits(wh)
    for n in (1, 1, 2):
        slices = commits.replace(frames(spark, n))
        assert state(wh) == all_are(n) and slices == {TOP.full_name: REFS, UF.full_name: REFS}
    commits.replace(frames(spark, 3, REFS[:2]))
    assert state(wh) == {s.name: dict(zip(REFS, (3, 3, 2, 2, 2), strict=True)) for s in (TOP, UF)}
    commits.replace(frames(spark, 4, REFS[:1]), REFS[:3])  # named slices without rows go
    assert state(wh) == {s.name: {REFS[0]: 4, REFS[3]: 2, REFS[4]: 2} for s in (TOP, UF)}


def test_a_row_of_another_slice_undoes_the_commit(wh, spark):
    commits = Commits(wh)
    commits.replace(frames(spark, 1))
    with pytest.raises(Exception, match="2024-05"):
        commits.replace(frames(spark, 2), REFS[:4])
    assert state(wh) == all_are(1) and commits.recover() == {"finished": [], "undone": []}


@pytest.mark.parametrize("applied", (0, 3, 10))
def test_crash_while_the_switch_is_applied(wh, spark, applied):
    commits = Commits(wh)
    commits.replace(frames(spark, 1))
    commit = Commit(commits)
    commit.stage(frames(spark, 2))
    commit.switch()
    commits.apply(commit.moves[:applied])
    assert Commits(wh).recover() == {"finished": [commit.name], "undone": []}
    assert state(wh) == all_are(2)
    assert Commits(wh).recover() == {"finished": [], "undone": []}


def test_crash_before_and_while_switching(wh, spark, monkeypatch):
    commits = Commits(wh)
    commits.replace(frames(spark, 1))
    commit = Commit(commits)
    commit.stage(frames(spark, 2))
    assert state(wh) == all_are(1)
    # The manifest is written under another name first, and never gets its own.
    monkeypatch.setattr(type(commits.files), "move", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError, match="lost"):
        commit.switch()
    monkeypatch.undo()
    assert Commits(wh).recover() == {"finished": [], "undone": [commit.name]}
    assert state(wh) == all_are(1)
    assert not commits.files.exists(commits.folder(TOP, commit.name))


def test_crash_after_the_switch_is_finished_before_the_next_commit(wh, spark):
    commits = Commits(wh)
    commits.replace(frames(spark, 1))
    commit = Commit(commits)
    commit.stage(frames(spark, 2))
    commit.switch()
    Commits(wh).replace(frames(spark, 3, REFS[:2]))
    assert state(wh) == {s.name: dict(zip(REFS, (3, 3, 2, 2, 2), strict=True)) for s in (TOP, UF)}


def test_two_commits_of_one_slice(wh, spark):
    commits = Commits(wh)
    commits.replace(frames(spark, 1))
    with pytest.raises(RuntimeError, match="replaced meanwhile"), commits.open() as late:
        late.stage(frames(spark, 2))
        Commits(wh).replace(frames(spark, 3, REFS[:1]))
    assert state(wh) == {s.name: dict(zip(REFS, (3, 1, 1, 1, 1), strict=True)) for s in (TOP, UF)}


def test_in_place_replacement_and_commits_go_together(wh, spark):
    wh.replace(TOP, frames(spark, 1)[TOP])
    Commits(wh).replace(frames(spark, 2))
    wh.replace(TOP, frames(spark, 5, REFS[:2])[TOP])
    wh.replace(TOP, frames(spark, 6, REFS[2:3])[TOP], REFS[2])
    assert state(wh)[TOP.name] == dict(zip(REFS, (5, 5, 6, 2, 2), strict=True)) and state(wh)[UF.name] == all_are(2)[UF.name]
    wh.replace(TOP, frames(spark, 7)[TOP].where("false"), REFS[3])
    assert REFS[3] not in state(wh)[TOP.name]


def test_a_new_catalog_finds_the_slices_of_commits(wh, spark):
    commits = Commits(wh)
    wh.replace(TOP, frames(spark, 1)[TOP])
    commits.replace(frames(spark, 2))
    commits.replace(frames(spark, 3, REFS[:1]), REFS[:2])
    before = state(wh)
    wh.drop()
    wh.create()
    assert state(wh) == before == {s.name: {REFS[0]: 3} | dict.fromkeys(REFS[2:], 2) for s in (TOP, UF)}


def test_vacuum_removes_replaced_folders_only(wh, spark):
    commits = Commits(wh)
    wh.replace(TOP, frames(spark, 1)[TOP])
    commits.replace(frames(spark, 2))
    commits.replace(frames(spark, 3, REFS[:2]))
    assert commits.vacuum() == 0  # too young
    assert commits.vacuum(0) == 5 + 2 * 2
    assert commits.vacuum(0) == 0
    assert state(wh) == {s.name: dict(zip(REFS, (3, 3, 2, 2, 2), strict=True)) for s in (TOP, UF)}


def test_publish_equals_the_chain(wh, spark, sf_dir, rows):
    chains.backfill_monthly(wh, complaints_monthly(spark, sf_dir))
    tables = [S.SILVER_MONTHLY, *S.GOLD_TABLES[:5]]
    want = {t.name: rows(wh.table(t)) for t in tables}
    for spec in tables:
        for ref in ("1995-02", "1996-03"):
            wh.clear(spec, ref)
    slices = chains.publish_monthly(wh, ["1995-02", "1996-03"])
    assert {t.name: rows(wh.table(t)) for t in tables} == want
    assert slices == {t.full_name: ["1995-02", "1996-03"] for t in tables}


def test_publish_daily(wh, spark, sf_dir, rows):
    chains.backfill_daily(wh, complaints_daily(spark, sf_dir).where("datrefcarga in ('20240110', '20240111')"))
    tables = [S.SILVER_DAILY, *S.GOLD_TABLES[5:]]
    want = {t.name: rows(wh.table(t)) for t in tables}
    chains.publish_daily(wh)
    assert {t.name: rows(wh.table(t)) for t in tables} == want


def test_several_slices_are_written_from_one_evaluation(wh, spark):
    """What a source gives twice may differ; it is asked once."""
    calls = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            calls.add(len(b))
            yield b

    source = frames(spark, 1)[TOP]
    counted = source.mapInPandas(count, source.schema)
    assert wh.replace(TOP, counted) == REFS and calls.value == len(REFS)
    Commits(wh).replace({TOP: counted})
    assert calls.value == 2 * len(REFS)
