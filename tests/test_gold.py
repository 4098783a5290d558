from collections import Counter, defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from ouvidoria.operators import classify, conform, gold
from ouvidoria.plans.fixtures import complaints_daily, complaints_monthly

SILVER = "nomefantasia string, grupoproblema string, uf string, notaconsumidor int, temporesposta int, " \
    "respondida boolean, datrefcarga string"


@pytest.fixture(scope="module")
def silver(spark, sf_dir):
    return conform.silver_monthly(complaints_monthly(spark, sf_dir)).persist()


@pytest.fixture(scope="module")
def classified(spark, sf_dir):
    return classify.classified_daily(conform.of_institution(complaints_daily(spark, sf_dir))).persist()


def test_mean_response_keeps_rows_without_days_in_the_denominator(spark):
    df = spark.createDataFrame(
        [("A", "g", "SP", 1, 10, True, "1"), ("A", "g", "SP", 1, None, True, "1"), ("A", "g", "SP", 1, 90, False, "1"),
         ("B", "g", "SP", 1, None, True, "1")], SILVER)
    assert {r.nomefantasia: r.mediaRespostaDias for r in gold.media_resposta(df).collect()} == {"A": 5.0, "B": None}
    assert df.where("respondida and nomefantasia = 'A'").agg(F.avg("temporesposta")).first()[0] == 10.0


def test_mean_score_rounds_half_up(spark):
    # 201 / 200 = 1.005
    df = spark.createDataFrame([("A", "g", "SP", 1 if i else 2, 1, True, "1") for i in range(200)], SILVER)
    assert gold.media_avaliacao(df).first().mediaAvaliacao == 1.01


def test_ratios_match_exact_arithmetic(silver):
    sums = defaultdict(lambda: [0, 0])
    for r in silver.where("notaconsumidor IS NOT NULL").collect():
        acc = sums[(r.nomefantasia, r.datrefcarga)]
        acc[0] += r.notaconsumidor
        acc[1] += 1
    want = {k: float((Decimal(s) / n).quantize(Decimal("0.01"), ROUND_HALF_UP)) for k, (s, n) in sums.items()}
    got = {(r.nomefantasia, r.datrefcarga): r.mediaAvaliacao for r in gold.media_avaliacao(silver).collect()}
    assert got == want


def test_null_state_gives_a_null_key(spark):
    df = spark.createDataFrame([("A", "g", None, 1, 1, True, "1"), ("A", "g", "SP", 1, 1, True, "1")], SILVER)
    assert {(r.uf, r.qtdReclamcoesUf) for r in gold.reclamacao_uf(df).collect()} == {(None, 1), ("Brasil - SP", 1)}


def test_top_ten_breaks_ties_by_name_and_equals_the_one_slice_form(spark, silver, rows):
    many = spark.createDataFrame([(f"B{i:02d}", "g", "SP", 1, 1, True, "1") for i in range(15)], SILVER)
    assert [r[0] for r in rows(gold.reclamacao_top_ten(many))] == [f"B{i:02d}" for i in range(10)]
    whole = gold.reclamacao_top_ten(silver)
    for ref in ["1995-03", "2000-01"]:
        assert rows(whole.where(F.col("datrefcarga") == ref)) == rows(gold.reclamacao_top_ten_of(silver, ref))


def test_counts_add_up_to_silver(silver, classified):
    n = silver.count()
    assert gold.grupo_problema(silver).agg(F.sum("qtdreclamcoes")).first()[0] == n
    assert gold.reclamacao_uf(silver).agg(F.sum("qtdReclamcoesUf")).first()[0] == n
    for aggregate in (gold.ai_status, gold.ai_nota, gold.ai_macro_categoria):
        assert aggregate(classified).agg(F.sum("qtd")).first()[0] == classified.count()


def test_rollups_give_the_same_golds(silver, classified, rows):
    direct = {
        "grupoproblema": gold.grupo_problema, "mediaavaliacao": gold.media_avaliacao,
        "mediaresposta": gold.media_resposta, "reclamacaotopten": gold.reclamacao_top_ten,
        "reclamacaouf": gold.reclamacao_uf,
    }
    from_rollup = gold.monthly_golds(gold.monthly_rollup(silver))
    assert set(from_rollup) == set(direct)
    for name, fn in direct.items():
        expected = fn(silver)
        assert rows(from_rollup[name].select(expected.columns)) == rows(expected), name
    daily = {"ai_status": gold.ai_status, "ai_nota": gold.ai_nota, "ai_macro_categoria": gold.ai_macro_categoria}
    from_rollup = gold.daily_golds(gold.daily_rollup(classified))
    for name, fn in daily.items():
        expected = fn(classified)
        assert rows(from_rollup[name].select(expected.columns)) == rows(expected), name


def test_score_texts_are_reduced_to_digits_before_grouping(spark):
    df = spark.createDataFrame([("4.5", "d", "1"), ("45", "d", "1"), ("ruim", "d", "1"), (None, "d", "1")],
                               "nota string, dataocorrido string, datrefcarga string")
    assert Counter({r.nota: r.qtd for r in gold.ai_nota(df).collect()}) == {"45": 2, "": 1, None: 1}


def test_plans_combine_before_the_shuffle(silver, spark, sf_dir, plan):
    df = conform.silver_monthly(complaints_monthly(spark, sf_dir))
    assert "partial_count" in plan(gold.grupo_problema(df))
    top = plan(gold.reclamacao_top_ten(df))
    assert top.count("WindowGroupLimit") >= 2  # cut in each task, then once more after the shuffle
    assert "TakeOrderedAndProject" in plan(gold.reclamacao_top_ten_of(df, "1995-03"))
