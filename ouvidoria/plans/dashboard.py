"""Dashboard datasets over the gold tables, widget queries and cross-filters."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ouvidoria.functions.dates import br_date
from ouvidoria.functions.text import institution_label, region_uf
from ouvidoria.schemas import SLICE_KEY

Selections = dict[str, list]


def _banco() -> Column:
    return institution_label(F.col("nomefantasia")).alias("Banco")


def _ano_mes() -> Column:
    return F.col(SLICE_KEY).alias("Ano_Mes")


def _data_ocorrido() -> Column:
    return br_date(F.col("dataocorrido")).alias("Data_Ocorrido")


def ds_reclamacao(reclamacaotopten: DataFrame) -> DataFrame:
    return reclamacaotopten.select(_banco(), F.col("qtdreclamcoes").alias("Qtd_Reclamacoes"), _ano_mes())


def ds_mediaresposta(mediaresposta: DataFrame) -> DataFrame:
    return mediaresposta.select(_banco(), F.col("mediaRespostaDias").alias("Media_Resposta_Dias"), _ano_mes())


def ds_mediaavaliacao(mediaavaliacao: DataFrame) -> DataFrame:
    return mediaavaliacao.select(_banco(), F.col("mediaAvaliacao").alias("Media_Avaliacao"), _ano_mes())


def ds_reclamacaouf(reclamacaouf: DataFrame) -> DataFrame:
    return reclamacaouf.select(
        _banco(), region_uf(F.col("uf")).alias("UF"), F.col("qtdReclamcoesUf").alias("Qtd_Reclamacoes_UF"), _ano_mes()
    )


def ds_macro_categoria(ai_macro_categoria: DataFrame) -> DataFrame:
    return ai_macro_categoria.select(
        F.col("macro_categoria").alias("Macro_Categoria"), _data_ocorrido(), F.col("qtd").alias("Qtd")
    )


def ds_nota(ai_nota: DataFrame) -> DataFrame:
    """Only scores that are numbers; a digit run beyond int has no weight."""
    nota = F.col("nota")
    return ai_nota.where((nota != "") & nota.rlike("^[0-9]+$")).select(
        nota.alias("Nota"),
        _data_ocorrido(),
        F.col("qtd").alias("Qtd"),
        (nota.try_cast("int") * F.col("qtd")).alias("Nota_Ponderada"),
    )


def ds_status(ai_status: DataFrame) -> DataFrame:
    return ai_status.select(F.col("status").alias("Status"), _data_ocorrido(), F.col("qtd").alias("Qtd"))


# Dataset, and the gold table that it reads.
DATASETS: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "ds_reclamacao": ("reclamacaotopten", ds_reclamacao),
    "ds_mediaresposta": ("mediaresposta", ds_mediaresposta),
    "ds_mediaavaliacao": ("mediaavaliacao", ds_mediaavaliacao),
    "ds_reclamacaouf": ("reclamacaouf", ds_reclamacaouf),
    "ds_macro_categoria": ("ai_macro_categoria", ds_macro_categoria),
    "ds_nota": ("ai_nota", ds_nota),
    "ds_status": ("ai_status", ds_status),
}


@dataclass(frozen=True)
class Widget:
    """Dimensions, measures (name to aggregate) and axis order over one dataset."""

    dataset: str
    measures: dict[str, Callable[[], Column]]
    dims: tuple[str, ...] = ()
    order: tuple[Callable[[], Column], ...] = field(default=())


def _sum(column: str) -> dict[str, Callable[[], Column]]:
    return {f"sum({column})": lambda: F.sum(column)}


def _avg(column: str) -> dict[str, Callable[[], Column]]:
    """Mean of values that gold has rounded to at most two digits.

    Summed as decimals, so that the result does not depend on the order of rows.
    """
    exact = lambda: F.sum(F.col(column).cast("decimal(18,2)")).cast("double")
    return {f"avg({column})": lambda: F.try_divide(exact(), F.count(column))}


def _bar(dataset: str, dim: str, measure: str) -> Widget:
    """Longest bar first, equal ones by label."""
    return Widget(
        dataset, _sum(measure), (dim,), (lambda: F.col(f"sum({measure})").desc(), lambda: F.col(dim).asc())
    )


def _by_label(dataset: str, measure: str, *dims: str) -> Widget:
    return Widget(dataset, _sum(measure), dims, tuple((lambda d=d: F.col(d).asc()) for d in dims))


def _weighted_score() -> Column:
    return F.try_divide(F.sum("Nota_Ponderada"), F.sum("Qtd"))


WIDGETS: dict[str, Widget] = {
    "kpi_total_reclamacoes": Widget("ds_reclamacao", _sum("Qtd_Reclamacoes")),
    "kpi_media_resposta": Widget("ds_mediaresposta", _avg("Media_Resposta_Dias")),
    "kpi_media_avaliacao": Widget("ds_mediaavaliacao", _avg("Media_Avaliacao")),
    "bar_reclamacoes_instituicao": _bar("ds_reclamacao", "Banco", "Qtd_Reclamacoes"),
    "bar_reclamacoes_uf": _bar("ds_reclamacaouf", "UF", "Qtd_Reclamacoes_UF"),
    "line_reclamacoes_mes": _by_label("ds_reclamacao", "Qtd_Reclamacoes", "Ano_Mes"),
    "kpi_total_relatos": Widget("ds_macro_categoria", _sum("Qtd")),
    "kpi_nota_media": Widget("ds_nota", {"nota_media_ponderada": _weighted_score}),
    "kpi_total_categorias": Widget(
        "ds_macro_categoria", {"count_distinct_categorias": lambda: F.count_distinct("Macro_Categoria")}
    ),
    "bar_macro_categoria": _bar("ds_macro_categoria", "Macro_Categoria", "Qtd"),
    "bar_status": _bar("ds_status", "Status", "Qtd"),
    "bar_nota": _by_label("ds_nota", "Qtd", "Nota"),
    "line_evolucao_macro": _by_label("ds_macro_categoria", "Qtd", "Data_Ocorrido"),
    "line_evolucao_status": _by_label("ds_status", "Qtd", "Data_Ocorrido", "Status"),
    "line_evolucao_nota": _by_label("ds_nota", "Qtd", "Data_Ocorrido", "Nota"),
}


def render(df: DataFrame, widget: Widget) -> DataFrame:
    """Aggregate a (filtered) dataset for a widget; the sort is over grouped rows only."""
    aggregates = [make().alias(name) for name, make in widget.measures.items()]
    grouped = df.groupBy(*widget.dims).agg(*aggregates) if widget.dims else df.agg(*aggregates)
    return grouped.orderBy(*[make() for make in widget.order]) if widget.order else grouped


def selection_predicate(df: DataFrame, selections: Selections, skip: str | None = None) -> Column:
    """AND over the selected fields that ``df`` has. An empty selection filters nothing; a selected
    ``None`` matches null."""
    parts = [
        _matches(F.col(name), values)
        for name, values in selections.items()
        if values and name != skip and name in df.columns
    ]
    return reduce(lambda a, b: a & b, parts) if parts else F.lit(True)


def _matches(c: Column, values: list) -> Column:
    known = [v for v in values if v is not None]
    parts = ([c.isin(known)] if known else []) + ([c.isNull()] if len(known) < len(values) else [])
    return reduce(lambda a, b: a | b, parts)


def cross_filter(df: DataFrame, selections: Selections) -> DataFrame:
    """Multi-select filters, applied to every dataset that has the field, before aggregation."""
    return df.where(selection_predicate(df, selections))


def facet(df: DataFrame, name: str, selections: Selections | None = None) -> DataFrame:
    """Every value of a filter field, with the number of rows that the *other* filters leave."""
    other = selection_predicate(df, selections or {}, skip=name)
    return df.groupBy(name).agg(F.count_if(other).alias(f"{name}_associativity"))
