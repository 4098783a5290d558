"""Every registered query against its DuckDB SQL, and the contract of the entry module."""

import pytest
from check_oracle import compare, connect

import __spark_entry__ as driver
from ouvidoria.plans import oracle, registry

QUERIES, ORACLE = registry.registered(), oracle.statements()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLE) <= set(driver.oracle_sql())


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns == ["Banco", "sum(Qtd_Reclamacoes)"] and df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, sf_dir, con):
    assert compare(QUERIES[name](spark, sf_dir), con, ORACLE[name]) is None


@pytest.mark.parametrize("name", ["facet_banco", "facet_ano_mes", "facet_data_ocorrido"])
def test_facets_read_the_rollup_and_not_the_feed(spark, sf_dir, name):
    """The feed is scanned once, for the checkpointed rollup; no dataset of a facet scans it again."""
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan and "Scan ExistingRDD" in plan
