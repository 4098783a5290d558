import datetime as dt

import pytest
from pyspark.sql import functions as F

from ouvidoria.functions import dates, text


def values(spark, inputs, *builders):
    """Results of column functions over one text column."""
    columns = [part for b in builders for part in (lambda c: c if isinstance(c, list) else [c])(b(F.col("c")))]
    df = spark.createDataFrame([(v,) for v in inputs], "c string").coalesce(1)
    return [tuple(r) if len(columns) > 1 else r[0] for r in df.select(*columns).collect()]


def test_br_date_is_lenient_and_strict_in_form(spark):
    inputs = ["15/01/2026", "31/02/2026", "1/2/2026", " 15/01/2026", "2026-01-15", "", "xx", None]
    assert values(spark, inputs, dates.br_date) == [dt.date(2026, 1, 15)] + [None] * 7


def test_iso_date_and_int_never_raise(spark):
    assert values(spark, ["2026-01-15", "15/01/2026", "", None], dates.iso_date) == [
        dt.date(2026, 1, 15), None, None, None,
    ]
    assert values(spark, ["7", " 7 ", "4.5", "", None, "99999999999"], dates.to_int) == [7, 7, None, None, None, None]


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo"])
def test_counter_timestamp_ignores_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # Midnight of 2018-11-04 does not exist in the second zone.
        got = values(
            spark,
            ["Relatos desde 04/11/2018, 00:10:00", "desde  01/02/2024 23:59:59 ", "sem data", "desde ontem", None],
            dates.counter_timestamp,
        )
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == [dt.datetime(2018, 11, 4, 0, 10), dt.datetime(2024, 2, 1, 23, 59, 59), None, None, None]


def test_default_refs(spark):
    day = F.lit("2024-03-15").cast("date")
    got = values(spark, ["", "2020-05", "  ", None], lambda c: dates.monthly_ref(day, c), lambda c: dates.daily_ref(day, c))
    assert got[0] == ("2024-02", "20240315")
    assert got[1] == ("2020-05", "2020-05")
    assert got[2] == got[3] == ("2024-02", "20240315")


def test_scores(spark):
    inputs = ["4.5", "Nota 10/5", "<não avaliado>", "nota 3", None]
    assert values(spark, inputs, text.digits_only) == ["45", "105", "", "3", None]
    assert values(spark, inputs, text.parse_score) == [4.5, 10.0, None, 3.0, None]


def test_institution_label(spark):
    inputs = ["Banco do Brasil", "Banco do Nordeste ", "Banco Bancoob", "Banco Santander", "Nubank", None]
    assert values(spark, inputs, text.institution_label) == [
        "Banco do Brasil", "Banco do Nordeste ", "ob", "Santander", "Nubank", None,
    ]


def test_region_key_and_back(spark):
    assert values(spark, ["SP", None], text.region_key) == ["Brasil - SP", None]
    assert values(spark, ["Brasil - SP", "RJ "], text.region_uf) == ["SP", "RJ"]


def test_clean_label_cuts_before_it_cleans(spark):
    assert values(spark, ['"Cartões"\n', 'ab\r\n"cd', None], lambda c: text.clean_label(c, 5)) == ["Cart", "ab", None]
    assert values(spark, ['  "Outros"  '], lambda c: text.clean_label(c, 50)) == ["Outros"]


def test_location_by_last_hyphen_and_by_position(spark):
    inputs = ["01/02/2024, Ji-Paraná - RO", "01/02/2024, São Paulo - SP"]
    fixed = values(spark, inputs, lambda c: list(text.location_parts(c).values()))
    positional = values(spark, inputs, lambda c: list(text.location_parts_positional(c).values()))
    assert fixed == [("01/02/2024", "Ji-Paraná", "RO"), ("01/02/2024", "São Paulo", "SP")]
    assert positional == [("01/02/2024", "Ji", "Paraná"), ("01/02/2024", "São Paulo", "SP")]


def test_small_text_functions(spark):
    assert values(spark, ["(2 dias)", "a|b"], text.strip_parentheses, text.protect_separator) == [
        ("2 dias", "(2 dias)"), ("a|b", "a;b"),
    ]
    url = "https://x.org/https/base2024-01.csv"
    assert values(spark, [url], text.plain_http, lambda c: text.landing_key(text.plain_http(c))) == [
        ("http://x.org/http/base2024-01.csv", "tmp/base2024-01.csv")
    ]
    assert values(spark, ["n1,c1,n2"], lambda c: text.every_other(F.split(c, ","), 0), lambda c: text.every_other(F.split(c, ","), 1)) == [
        (["n1", "n2"], ["c1"])
    ]
