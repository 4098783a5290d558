"""Typed conformance and the row filters of the silver layer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ouvidoria.functions import dates
from ouvidoria.schemas import BR_DATE_COLUMNS, FLAG_COLUMNS, INT_COLUMNS, ISO_DATE_COLUMNS, SLICE_KEY

# The prefix and the sector that silver keeps, and the marker of a set flag.
BANK_PATTERN = "Banco%"
FINANCIAL_AREA = "Serviços Financeiros"
YES = "S"


def qualify_types(df: DataFrame, columns: list[str], expressions: list[Column]) -> DataFrame:
    """Replace columns by expressions, in place, as one projection."""
    return df.withColumns(dict(zip(columns, expressions, strict=True)))


def flag(c: Column) -> Column:
    """``'S'`` is true; anything else, null included, is false."""
    return F.coalesce(c == YES, F.lit(False))


def conform(df: DataFrame, closing_date_br: bool = False) -> DataFrame:
    """All-text monthly rows to silver types; values that do not parse become null.

    ``closing_date_br`` also accepts ``dd/MM/yyyy`` for the closing date, which is ISO otherwise.
    """
    typed = {name: dates.br_date(F.col(name)) for name in BR_DATE_COLUMNS}
    for name in ISO_DATE_COLUMNS:
        iso = dates.iso_date(F.col(name))
        typed[name] = F.coalesce(iso, dates.br_date(F.col(name))) if closing_date_br else iso
    typed |= {name: dates.to_int(F.col(name)) for name in INT_COLUMNS}
    typed |= {name: flag(F.col(name)) for name in FLAG_COLUMNS}
    return df.withColumns(typed)


def conform_with_rejects(df: DataFrame, closing_date_br: bool = False) -> DataFrame:
    """Typed rows as ``conform`` gives them, and ``rejects``: column and raw value of what did not parse.

    One pass: a row is typed once, and its rejects are a short list beside it. Blank values are not rejects.
    """
    names = [*BR_DATE_COLUMNS, *ISO_DATE_COLUMNS, *INT_COLUMNS]
    kept = df.withColumns({f"_raw_{n}": F.col(n) for n in names})
    typed = conform(kept, closing_date_br)
    failed = [
        F.when(F.col(n).isNull() & (F.trim(f"_raw_{n}") != ""), F.struct(F.lit(n).alias("column"), F.col(f"_raw_{n}").alias("value")))
        for n in names
    ]
    listed = typed.withColumn("rejects", F.array_compact(F.array(*failed)))
    return listed.drop(*[f"_raw_{n}" for n in names])


def counted(rows: DataFrame, metrics: Observation) -> DataFrame:
    """The same rows; when they are written, ``metrics`` holds how many there were and how many had rejects, by column."""
    names = [*BR_DATE_COLUMNS, *ISO_DATE_COLUMNS, *INT_COLUMNS]
    has = lambda n: F.exists("rejects", lambda r: r["column"] == n)
    by_column = [F.count_if(has(n)).alias(n) for n in names]
    return rows.observe(metrics, F.count(F.lit(1)).alias("rows"), F.count_if(F.size("rejects") > 0).alias("rejected"), *by_column)


def rejects(rows: DataFrame, load: str = SLICE_KEY) -> DataFrame:
    """(column, value, load) of every value that did not parse."""
    return rows.select(F.inline("rejects"), load)


def financial_banks(df: DataFrame, name: str = "nomefantasia", area: str = "area") -> DataFrame:
    """Banks of the financial sector: a case-sensitive prefix and an exact sector."""
    return df.where(F.col(name).like(BANK_PATTERN) & (F.col(area) == FINANCIAL_AREA))


def of_institution(df: DataFrame, institution: str = "Santander", name: str = "nomeempresa") -> DataFrame:
    return df.where(F.col(name).contains(institution))


def silver_monthly(bronze: DataFrame, closing_date_br: bool = False) -> DataFrame:
    """Filter first, so that only kept rows are parsed."""
    return bronze.transform(financial_banks).transform(lambda df: conform(df, closing_date_br))
