"""SQL functions of the dashboard against the DataFrame form, with and without filters."""

import uuid

import pytest
from pyspark.sql import functions as F

from ouvidoria import schemas as S
from ouvidoria.plans import dashboard, registry, sql_api
from ouvidoria.sources.tables import Warehouse


@pytest.fixture(scope="module")
def wh(spark, tmp_path_factory, sf_dir):
    warehouse = Warehouse(spark, str(tmp_path_factory.mktemp("wh")), f"q{uuid.uuid4().hex[:8]}_")
    warehouse.create(S.GOLD_TABLES)
    golds = registry._monthly_golds(spark, sf_dir) | registry._daily_golds(spark, sf_dir)
    warehouse.replace_many({registry._SPECS[name]: df for name, df in golds.items()})
    names = sql_api.install(warehouse)
    yield warehouse
    sql_api.uninstall(spark, names)
    warehouse.drop()


FILTERS = [
    ({}, ""),
    ({"Banco": ["Santander", "B7"], "Ano_Mes": ["1996-03", "1995-02"]}, "bancos => array('Santander', 'B7'), meses => array('1996-03', '1995-02')"),
    ({"Data_Ocorrido": ["2024-01-05"]}, "dias => array(DATE'2024-01-05')"),
]


@pytest.mark.parametrize(("chosen", "call"), FILTERS)
def test_widgets(wh, spark, rows, chosen, call):
    for name, widget in dashboard.WIDGETS.items():
        gold, build = dashboard.DATASETS[widget.dataset]
        df = dashboard.cross_filter(build(wh.table(registry._SPECS[gold])), {k: [F.lit(x).cast("date") for x in v] if k == "Data_Ocorrido" else v for k, v in chosen.items()})
        want = dashboard.render(df, widget)
        got = spark.sql(f"SELECT * FROM {wh.prefix}{name}({call})")
        assert got.dtypes == want.dtypes and rows(got) == rows(want), name


def test_datasets(wh, spark, rows):
    for name, (gold, build) in dashboard.DATASETS.items():
        want = build(wh.table(registry._SPECS[gold]))
        got = spark.sql(f"SELECT * FROM {wh.prefix}{name}()")
        assert got.dtypes == want.dtypes and rows(got) == rows(want), name


def test_a_month_prunes_slices(wh, spark, plan):
    text = plan(spark.sql(f"SELECT * FROM {wh.prefix}bar_reclamacoes_uf(meses => array('1996-03'))"))
    filters = next(line for line in text.splitlines() if "PartitionFilters" in line)
    assert "datrefcarga" in filters and "ReadSchema: struct<uf:string,qtdReclamcoesUf:bigint>" in text
