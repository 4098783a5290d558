"""Datasets and widgets as SQL table functions of the catalog, with the dashboard's filters as parameters.

``SELECT * FROM bar_reclamacoes_uf(bancos => array('Santander'), meses => array('2026-01'))``: a filter that is not given
filters nothing. The functions are SQL, so a call is one Catalyst plan: a filter on the month prunes slices, and only the
columns that a widget needs are read. Names carry the warehouse's prefix and lie in the current database, since Spark
finds table functions by a single name.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ouvidoria import schemas as S
from ouvidoria.functions.text import BANK_WORD, FULL_NAME_BANKS
from ouvidoria.plans.dashboard import WIDGETS, Widget
from ouvidoria.sources.tables import Warehouse

_PARAMETERS = {"bancos": "ARRAY<STRING>", "meses": "ARRAY<STRING>", "dias": "ARRAY<DATE>"}
# Filter parameter -> the dataset column that it selects.
_FILTERS = {"bancos": "Banco", "meses": "Ano_Mes", "dias": "Data_Ocorrido"}

_BANCO = (
    f"CASE WHEN trim(nomefantasia) IN ({', '.join(repr(b) for b in FULL_NAME_BANKS)}) THEN nomefantasia "
    f"ELSE trim(replace(nomefantasia, '{BANK_WORD}', '')) END"
)
_DIA = "try_to_date(dataocorrido, 'dd/MM/yyyy')"

# Dataset -> gold table, row filter, and columns with their types and expressions.
_DATASETS: dict[str, tuple[S.TableSpec, str, dict[str, tuple[str, str]]]] = {
    "ds_reclamacao": (
        S.GOLD_TOP_TEN, "true",
        {"Banco": ("STRING", _BANCO), "Qtd_Reclamacoes": ("BIGINT", "qtdreclamcoes"), "Ano_Mes": ("STRING", S.SLICE_KEY)},
    ),
    "ds_mediaresposta": (
        S.GOLD_RESPOSTA, "true",
        {"Banco": ("STRING", _BANCO), "Media_Resposta_Dias": ("DOUBLE", "mediaRespostaDias"), "Ano_Mes": ("STRING", S.SLICE_KEY)},
    ),
    "ds_mediaavaliacao": (
        S.GOLD_AVALIACAO, "true",
        {"Banco": ("STRING", _BANCO), "Media_Avaliacao": ("DOUBLE", "mediaAvaliacao"), "Ano_Mes": ("STRING", S.SLICE_KEY)},
    ),
    "ds_reclamacaouf": (
        S.GOLD_UF, "true",
        {
            "Banco": ("STRING", _BANCO), "UF": ("STRING", "trim(replace(uf, 'Brasil - ', ''))"),
            "Qtd_Reclamacoes_UF": ("BIGINT", "qtdReclamcoesUf"), "Ano_Mes": ("STRING", S.SLICE_KEY),
        },
    ),
    "ds_macro_categoria": (
        S.GOLD_MACRO, "true",
        {"Macro_Categoria": ("STRING", "macro_categoria"), "Data_Ocorrido": ("DATE", _DIA), "Qtd": ("BIGINT", "qtd")},
    ),
    "ds_nota": (
        S.GOLD_NOTA, "nota <> '' AND nota RLIKE '^[0-9]+$'",
        {
            "Nota": ("STRING", "nota"), "Data_Ocorrido": ("DATE", _DIA), "Qtd": ("BIGINT", "qtd"),
            "Nota_Ponderada": ("BIGINT", "try_cast(nota AS INT) * qtd"),
        },
    ),
    "ds_status": (
        S.GOLD_STATUS, "true",
        {"Status": ("STRING", "status"), "Data_Ocorrido": ("DATE", _DIA), "Qtd": ("BIGINT", "qtd")},
    ),
}


def _measure(name: str) -> tuple[str, str]:
    """Type and aggregate of a widget's measure, by its name."""
    if name == "nota_media_ponderada":
        return "DOUBLE", "try_divide(sum(Nota_Ponderada), sum(Qtd))"
    if name == "count_distinct_categorias":
        return "BIGINT", "count(DISTINCT Macro_Categoria)"
    function, column = name.removesuffix(")").split("(")
    if function == "avg":
        return "DOUBLE", f"try_divide(CAST(sum(CAST({column} AS DECIMAL(18, 2))) AS DOUBLE), count({column}))"
    return "BIGINT", f"sum({column})"


def _function(name: str, columns: dict[str, str], body: str) -> str:
    parameters = ", ".join(f"{p} {kind} DEFAULT NULL" for p, kind in _PARAMETERS.items())
    returned = ", ".join(f"`{c}` {kind}" for c, kind in columns.items())
    return f"CREATE OR REPLACE FUNCTION {name}({parameters}) RETURNS TABLE ({returned}) RETURN {body}"


def _dataset_body(wh: Warehouse, function: str, dataset: str) -> str:
    """Filters stand on expressions of the stored columns, below any aggregate; the month's is the slice key itself."""
    spec, kept, columns = _DATASETS[dataset]
    tests = [kept] + [
        f"({function}.{p} IS NULL OR array_contains({function}.{p}, {columns[c][1]}))" for p, c in _FILTERS.items() if c in columns
    ]
    listed = ", ".join(f"{expression} AS `{c}`" for c, (_, expression) in columns.items())
    return f"SELECT {listed} FROM {wh.name(spec)} WHERE {' AND '.join(tests)}"


def _widget(wh: Warehouse, function: str, widget: Widget) -> str:
    columns = _DATASETS[widget.dataset][2]
    measures = {m: _measure(m) for m in widget.measures}
    listed = ", ".join([f"`{d}`" for d in widget.dims] + [f"{aggregate} AS `{m}`" for m, (_, aggregate) in measures.items()])
    group = f" GROUP BY {', '.join(f'`{d}`' for d in widget.dims)}" if widget.dims else ""
    returned = {d: columns[d][0] for d in widget.dims} | {m: kind for m, (kind, _) in measures.items()}
    return _function(function, returned, f"SELECT {listed} FROM ({_dataset_body(wh, function, widget.dataset)}){group}")


def install(wh: Warehouse) -> list[str]:
    """Create or replace the functions of all datasets and widgets; returns their names."""
    statements = {
        name: _function(f"{wh.prefix}{name}", {c: kind for c, (kind, _) in columns.items()}, _dataset_body(wh, f"{wh.prefix}{name}", name))
        for name, (_, _, columns) in _DATASETS.items()
    }
    statements |= {name: _widget(wh, f"{wh.prefix}{name}", widget) for name, widget in WIDGETS.items()}
    for statement in statements.values():
        wh.spark.sql(statement)
    return [f"{wh.prefix}{name}" for name in statements]


def uninstall(spark: SparkSession, names: list[str]) -> None:
    for name in names:
        spark.sql(f"DROP FUNCTION IF EXISTS {name}")
