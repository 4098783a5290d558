"""Registry of feeds and tables: one declaration drives readers, DDL and writers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICE_KEY = "datrefcarga"

# Column names and order of the two delimited feeds.
MONTHLY_FIELDS = [
    "gestor", "canalOrigem", "regiao", "uf", "cidade", "sexo", "faixaEtaria", "anoAbertura",
    "mesAbertura", "dataAbertura", "dataResposta", "dataAnalise", "dataRecusa", "dataFinalizacao",
    "prazoResposta", "prazoAnaliseGestor", "tempoResposta", "nomeFantasia", "segmentoMercado",
    "area", "assunto", "grupoProblema", "problema", "comoContratou", "procurouEmpresa",
    "respondida", "situacao", "avaliacaoReclamacao", "notaConsumidor", "analiseRecusa",
]
DAILY_FIELDS = [
    "nomeEmpresa", "status", "tempoResposta", "dataOcorrido", "Cidade", "UF", "Relato",
    "Resposta", "Nota", "Comentario",
]

# Columns of the monthly feed that silver stores typed.
BR_DATE_COLUMNS = ["dataabertura", "dataresposta", "dataanalise", "datarecusa", "prazoresposta"]
ISO_DATE_COLUMNS = ["datafinalizacao"]
INT_COLUMNS = ["anoabertura", "mesabertura", "prazoanalisegestor", "temporesposta", "notaconsumidor"]
FLAG_COLUMNS = ["procurouempresa", "respondida"]

# Columns that classification adds to the daily feed, in stored order.
CLASSIFIED_FIELDS = [
    "macro_categoria", "categoria", "subcategoria", "canal", "prioridade", "sla_dias",
    "resposta_sugerida", "resposta_final",
]


def string_struct(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def _silver_type(name: str) -> str:
    if name in BR_DATE_COLUMNS or name in ISO_DATE_COLUMNS:
        return "date"
    if name in INT_COLUMNS:
        return "int"
    return "boolean" if name in FLAG_COLUMNS else "string"


@dataclass(frozen=True)
class TableSpec:
    """A catalog table. ``columns`` is the declared order, which readers see."""

    database: str
    name: str
    columns: tuple[tuple[str, str], ...]

    @property
    def full_name(self) -> str:
        return f"{self.database}.{self.name}"

    @property
    def path_suffix(self) -> str:
        return f"data/{self.database}/{self.name}"

    @property
    def column_names(self) -> list[str]:
        return [name for name, _ in self.columns]

    def stored_columns(self) -> list[tuple[str, str]]:
        """Physical order: Spark keeps the partition column last."""
        data = [c for c in self.columns if c[0] != SLICE_KEY]
        return data + [c for c in self.columns if c[0] == SLICE_KEY]

    def conform(self, df: DataFrame, stored: bool = False) -> DataFrame:
        """Select by name, in declared or physical order, with the declared name and type."""
        columns = self.stored_columns() if stored else self.columns
        return df.select(*[F.col(name).cast(dtype).alias(name) for name, dtype in columns])


def _spec(database: str, name: str, columns: list[tuple[str, str]]) -> TableSpec:
    return TableSpec(database, name, tuple(columns))


def _strings(names: list[str]) -> list[tuple[str, str]]:
    return [(name, "string") for name in names]


_MONTHLY = [name.lower() for name in MONTHLY_FIELDS]
_DAILY = [name.lower() for name in DAILY_FIELDS]

# Databases, table names and declared schemas.
BRONZE, SILVER, GOLD = "b_consumidor", "s_consumidor", "g_consumidor"

BRONZE_DAILY = _spec(BRONZE, "consumidor_dia", _strings([*_DAILY, SLICE_KEY]))
BRONZE_MONTHLY = _spec(BRONZE, "consumidor", _strings([*_MONTHLY, SLICE_KEY]))
SILVER_MONTHLY = _spec(
    SILVER,
    "consumidorservicosfinanceiros",
    [(name, _silver_type(name)) for name in _MONTHLY] + [(SLICE_KEY, "string")],
)
SILVER_DAILY = _spec(
    SILVER, "ai_classificacao_relatos", _strings([*_DAILY, SLICE_KEY, *CLASSIFIED_FIELDS])
)
GOLD_PROBLEMA = _spec(
    GOLD,
    "grupoproblema",
    [("nomefantasia", "string"), ("grupoproblema", "string"), (SLICE_KEY, "string"), ("qtdreclamcoes", "bigint")],
)
GOLD_AVALIACAO = _spec(
    GOLD, "mediaavaliacao", [("nomefantasia", "string"), (SLICE_KEY, "string"), ("mediaAvaliacao", "double")]
)
GOLD_RESPOSTA = _spec(
    GOLD, "mediaresposta", [("nomefantasia", "string"), (SLICE_KEY, "string"), ("mediaRespostaDias", "double")]
)
GOLD_TOP_TEN = _spec(
    GOLD, "reclamacaotopten", [("nomefantasia", "string"), (SLICE_KEY, "string"), ("qtdreclamcoes", "bigint")]
)
GOLD_UF = _spec(
    GOLD,
    "reclamacaouf",
    [("nomefantasia", "string"), ("uf", "string"), (SLICE_KEY, "string"), ("qtdReclamcoesUf", "bigint")],
)
GOLD_STATUS = _spec(
    GOLD,
    "ai_status",
    [("status", "string"), ("dataocorrido", "string"), (SLICE_KEY, "string"), ("qtd", "bigint")],
)
GOLD_NOTA = _spec(
    GOLD, "ai_nota", [("nota", "string"), ("dataocorrido", "string"), (SLICE_KEY, "string"), ("qtd", "bigint")]
)
GOLD_MACRO = _spec(
    GOLD,
    "ai_macro_categoria",
    [("macro_categoria", "string"), ("dataocorrido", "string"), (SLICE_KEY, "string"), ("qtd", "bigint")],
)

GOLD_TABLES = [
    GOLD_PROBLEMA, GOLD_AVALIACAO, GOLD_RESPOSTA, GOLD_TOP_TEN, GOLD_UF, GOLD_STATUS, GOLD_NOTA, GOLD_MACRO,
]
ALL_TABLES = [BRONZE_DAILY, BRONZE_MONTHLY, SILVER_MONTHLY, SILVER_DAILY, *GOLD_TABLES]
