import pytest
from pyspark.sql import functions as F

from ouvidoria.plans import dashboard as D
from ouvidoria.plans import registry


@pytest.fixture(scope="module")
def uf(spark, sf_dir):
    return registry.dataset_frame(spark, sf_dir, "ds_reclamacaouf").persist()


def test_every_widget_has_a_dataset_and_runs():
    assert len(D.DATASETS) == 7 and len(D.WIDGETS) == 15
    assert {w.dataset for w in D.WIDGETS.values()} == set(D.DATASETS)


def test_bars_are_sorted_by_measure_then_label(spark):
    df = spark.createDataFrame([("B", 1), ("A", 1), ("C", 5), ("B", 1)], "Status string, Qtd long")
    got = [tuple(r) for r in D.render(df, D.WIDGETS["bar_status"]).collect()]
    assert got == [("C", 5), ("B", 2), ("A", 1)]


def test_scores_sort_as_text(spark):
    df = spark.createDataFrame([("2", 1), ("10", 1), ("1", 3)], "Nota string, Qtd long")
    assert [r.Nota for r in D.render(df, D.WIDGETS["bar_nota"]).collect()] == ["1", "10", "2"]


def test_weighted_mean_and_empty_dataset(spark):
    df = spark.createDataFrame([(10, 2), (45, 1)], "Nota_Ponderada long, Qtd long")
    assert D.render(df, D.WIDGETS["kpi_nota_media"]).first()[0] == 55 / 3
    assert D.render(df.where("false"), D.WIDGETS["kpi_nota_media"]).first()[0] is None


def test_score_dataset_keeps_numbers_only(spark):
    df = spark.createDataFrame([("5", "01/01/2024", "x", 2), ("", "01/01/2024", "x", 1), (None, "01/01/2024", "x", 1),
                                ("99999999999", "31/02/2024", "x", 1)],
                               "nota string, dataocorrido string, datrefcarga string, qtd long")
    got = [(r.Nota, r.Nota_Ponderada, r.Data_Ocorrido is None) for r in D.ds_nota(df).collect()]
    assert got == [("5", 10, False), ("99999999999", None, True)]


def test_cross_filter_ignores_absent_fields_and_empty_selections(uf):
    assert D.cross_filter(uf, {"Data_Ocorrido": ["x"], "Banco": []}).count() == uf.count()
    some = D.cross_filter(uf, {"Banco": ["Santander"], "Ano_Mes": ["1996-03"]})
    assert some.count() == uf.where("Banco = 'Santander' AND Ano_Mes = '1996-03'").count() > 0


def test_null_can_be_selected(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "Banco string, n int")
    assert {r.n for r in D.cross_filter(df, {"Banco": [None, "a"]}).collect()} == {1, 2}
    assert {r.n for r in D.cross_filter(df, {"Banco": [None]}).collect()} == {2}


def test_facet_counts_rows_under_the_other_filters(uf):
    total = D.facet(uf, "Banco").agg(F.sum("Banco_associativity")).first()[0]
    assert total == uf.count()
    facet = D.facet(uf, "Banco", {"Banco": ["Santander"], "Ano_Mes": ["1996-03"]})
    assert facet.count() == uf.select("Banco").distinct().count()  # every value is listed
    assert facet.agg(F.sum("Banco_associativity")).first()[0] == uf.where("Ano_Mes = '1996-03'").count()


def test_filters_are_pushed_below_the_aggregate_of_a_stored_gold(spark, plan, tmp_path):
    df = spark.createDataFrame([("Banco A", "Brasil - SP", "2024-01", 1)],
                               "nomefantasia string, uf string, datrefcarga string, qtdReclamcoesUf long")
    df.write.partitionBy("datrefcarga").parquet(str(tmp_path / "uf"))
    dataset = D.ds_reclamacaouf(spark.read.parquet(str(tmp_path / "uf")))
    text = plan(D.render(D.cross_filter(dataset, {"Ano_Mes": ["2024-01"]}), D.WIDGETS["bar_reclamacoes_uf"]))
    assert "PartitionFilters: [datrefcarga" in text or "PartitionFilters: [isnotnull(datrefcarga" in text
    assert "ReadSchema: struct<uf:string,qtdReclamcoesUf:bigint>" in text
