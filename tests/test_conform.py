import datetime as dt

import pytest
from pyspark.sql import functions as F

from ouvidoria import schemas as S
from ouvidoria.operators import conform
from ouvidoria.session import require_ref

NAMES = S.BRONZE_MONTHLY.column_names


def monthly(spark, *overrides):
    base = {
        "nomefantasia": "Banco X", "area": "Serviços Financeiros", "dataabertura": "15/01/2026",
        "datafinalizacao": "2026-01-20", "temporesposta": "3", "notaconsumidor": "5", "respondida": "S",
        "procurouempresa": None, "datrefcarga": "2026-01",
    }
    data = [tuple((base | o).get(n) for n in NAMES) for o in overrides]
    return spark.createDataFrame(data, S.string_struct(NAMES))


def test_types_and_positions_match_the_declared_table(spark):
    typed = conform.conform(monthly(spark, {}))
    assert typed.columns == NAMES
    assert [(n, t) for n, t in typed.dtypes] == list(S.SILVER_MONTHLY.columns)


def test_dirty_values_become_null_and_flags_default_to_false(spark):
    row = conform.conform(
        monthly(spark, {"dataabertura": "31/02/2026", "temporesposta": "4.5", "notaconsumidor": "", "respondida": None})
    ).first()
    assert (row.dataabertura, row.temporesposta, row.notaconsumidor) == (None, None, None)
    assert (row.respondida, row.procurouempresa) == (False, False)


def test_closing_date_is_iso_unless_told_otherwise(spark):
    df = monthly(spark, {"datafinalizacao": "20/01/2026"}, {"datafinalizacao": "2026-01-20"})
    iso = [r.datafinalizacao for r in conform.conform(df).collect()]
    both = [r.datafinalizacao for r in conform.conform(df, closing_date_br=True).collect()]
    assert iso == [None, dt.date(2026, 1, 20)]
    assert both == [dt.date(2026, 1, 20)] * 2


def test_financial_filter_is_case_sensitive_and_drops_null(spark):
    df = monthly(
        spark, {}, {"nomefantasia": "banco y"}, {"nomefantasia": " Banco Z"}, {"nomefantasia": None},
        {"area": "Telecomunicações"}, {"area": None},
    )
    assert [r.nomefantasia for r in conform.silver_monthly(df).collect()] == ["Banco X"]


def test_qualify_types_needs_one_expression_per_column(spark):
    df = spark.createDataFrame([("1", "a")], "x string, y string")
    out = conform.qualify_types(df, ["x"], [F.col("x").cast("int")])
    assert out.columns == ["x", "y"] and out.first().x == 1
    with pytest.raises(ValueError):
        conform.qualify_types(df, ["x", "y"], [F.col("x")])


def test_filters_reach_the_scan(spark, plan, tmp_path):
    monthly(spark, {}).write.parquet(str(tmp_path / "b"))
    text = plan(conform.silver_monthly(spark.read.parquet(str(tmp_path / "b"))))
    assert "StringStartsWith(nomefantasia,Banco)" in text and "EqualTo(area,Serviços Financeiros)" in text
    assert "Exchange" not in text


@pytest.mark.parametrize("ref", [None, "", "  ", "2026-01' OR '1'='1"])
def test_load_reference_is_mandatory_and_plain(ref):
    with pytest.raises(ValueError):
        require_ref(ref)


def test_rejects_are_what_did_not_parse(spark, plan, sf_dir):
    from pyspark.sql import Observation

    from ouvidoria import schemas as S
    from ouvidoria.plans.fixtures import complaints_monthly

    bronze = complaints_monthly(spark, sf_dir)
    rows = conform.conform_with_rejects(bronze)
    assert rows.drop("rejects").dtypes == conform.conform(bronze).dtypes
    blank = {"dataabertura": "31/02/2026", "dataanalise": " ", "datarecusa": None, "temporesposta": "4.5", "notaconsumidor": ""}
    one = spark.createDataFrame([tuple(blank.get(n.lower()) for n in S.MONTHLY_FIELDS) + ("2026-02",)], S.string_struct([n.lower() for n in S.MONTHLY_FIELDS] + ["datrefcarga"]))
    metrics = Observation()
    found = conform.counted(conform.conform_with_rejects(one), metrics)
    got = {tuple(r) for r in conform.rejects(found).collect()}
    assert got == {("dataabertura", "31/02/2026", "2026-02"), ("temporesposta", "4.5", "2026-02")}
    assert {k: v for k, v in metrics.get.items() if v} == {"rows": 1, "rejected": 1, "dataabertura": 1, "temporesposta": 1}
    assert plan(rows).count("Scan parquet") == plan(bronze).count("Scan parquet")
