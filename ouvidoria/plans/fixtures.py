"""The two feeds as views over the generic test tables, in Spark or DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Date patterns of the two engines by placeholder.
_SPARK_PATTERNS = {"Y": "yyyy", "M": "M", "DMY": "dd/MM/yyyy", "ISO": "yyyy-MM-dd", "YM": "yyyy-MM", "YMD": "yyyyMMdd"}
_DUCKDB_PATTERNS = {"Y": "%Y", "M": "%-m", "DMY": "%d/%m/%Y", "ISO": "%Y-%m-%d", "YM": "%Y-%m", "YMD": "%Y%m%d"}

_MONTHLY = """
SELECT concat('Gestor ', r_name) AS gestor, 'Plataforma Web' AS canalorigem, r_name AS regiao, n_name AS uf,
 concat('Cidade ', CAST(o_custkey % 50 AS STRING)) AS cidade,
 CASE o_custkey % 2 WHEN 0 THEN 'F' ELSE 'M' END AS sexo,
 CASE o_custkey % 3 WHEN 0 THEN 'até 20 anos' WHEN 1 THEN 'entre 31 a 40 anos' ELSE 'mais de 70 anos' END AS faixaetaria,
 <Y> AS anoabertura, <M> AS mesabertura,
 CASE WHEN o_orderkey % 97 = 0 THEN '31/02/2026' ELSE <DMY> END AS dataabertura,
 CASE WHEN o_orderstatus = 'P' THEN NULL ELSE <DMY> END AS dataresposta,
 CASE WHEN o_orderkey % 5 = 0 THEN <DMY> ELSE '' END AS dataanalise,
 CASE WHEN o_orderkey % 11 = 0 THEN <DMY> ELSE NULL END AS datarecusa,
 <ISO> AS datafinalizacao, <DMY> AS prazoresposta,
 CAST(o_orderkey % 10 AS STRING) AS prazoanalisegestor,
 CASE WHEN o_orderstatus = 'P' OR o_orderkey % 17 = 0 THEN '' ELSE CAST(o_orderkey % 31 AS STRING) END AS temporesposta,
 CASE o_custkey % 16 WHEN 0 THEN 'Banco do Brasil' WHEN 1 THEN 'Banco Santander' WHEN 2 THEN 'Banco do Nordeste '
  WHEN 3 THEN 'Banco Bancoob' WHEN 4 THEN ' Banco Inter' WHEN 5 THEN 'Nubank' WHEN 6 THEN NULL
  ELSE concat('Banco B', CAST(o_custkey % 16 AS STRING)) END AS nomefantasia,
 c_mktsegment AS segmentomercado,
 CASE WHEN o_orderkey % 5 = 0 THEN 'Telecomunicações' ELSE 'Serviços Financeiros' END AS area,
 c_mktsegment AS assunto, o_orderpriority AS grupoproblema, concat(o_orderpriority, '/', o_orderstatus) AS problema,
 'Internet' AS comocontratou,
 CASE o_orderkey % 4 WHEN 0 THEN 'S' WHEN 1 THEN NULL ELSE 'N' END AS procurouempresa,
 CASE WHEN o_orderstatus = 'P' THEN 'N' ELSE 'S' END AS respondida,
 o_orderstatus AS situacao,
 CASE WHEN o_orderkey % 3 = 0 THEN 'Não Avaliada' ELSE 'Avaliada' END AS avaliacaoreclamacao,
 CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE CAST(1 + o_orderkey % 5 AS STRING) END AS notaconsumidor,
 CAST(NULL AS STRING) AS analiserecusa, <YM> AS datrefcarga
FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey
 JOIN {region} ON n_regionkey = r_regionkey
"""

# Whole document texts, and every document in turn, so that the narratives grow with the tables.
# Both sides grow, hence a shuffled join; it also spreads a document file of a single row group.
_DAILY = """
SELECT /*+ MERGE(e) */ CASE event_id % 4 WHEN 0 THEN 'Nubank' ELSE 'Banco Santander' END AS nomeempresa,
 CASE event_type WHEN 'error' THEN 'Não Resolvido' WHEN 'purchase' THEN 'Resolvido' ELSE 'Não Avaliado' END AS status,
 concat(CAST(event_id % 10 AS STRING), ' dias') AS temporesposta, <DMY> AS dataocorrido,
 concat('Cidade-', CAST(user_id % 50 AS STRING)) AS cidade,
 CASE user_id % 3 WHEN 0 THEN 'SP' WHEN 1 THEN 'RJ' ELSE 'PA' END AS uf,
 CASE WHEN event_id % 53 = 0 THEN NULL ELSE concat(CASE event_id % 7
  WHEN 0 THEN 'Golpe por mensagem, conta invadida' WHEN 1 THEN 'Cobrança indevida na fatura'
  WHEN 2 THEN 'Cartão bloqueado sem aviso' WHEN 3 THEN 'Aplicativo fora do ar, erro de login'
  WHEN 4 THEN 'Conta bloqueada e saldo indisponível' WHEN 5 THEN 'Juros abusivos no contrato de crédito'
  ELSE 'Sem palavras conhecidas' END, '. ', text) END AS relato,
 'Resposta da empresa' AS resposta,
 CASE event_id % 8 WHEN 0 THEN '<não avaliado>' WHEN 1 THEN NULL WHEN 2 THEN 'Nota 10' WHEN 3 THEN '4.5'
  ELSE concat('nota ', CAST(1 + event_id % 5 AS STRING)) END AS nota,
 CASE WHEN event_id % 6 = 0 THEN NULL ELSE concat('comentário ', CAST(event_id AS STRING)) END AS comentario,
 <YMD> AS datrefcarga
FROM (SELECT *, event_id % (SELECT count(*) FROM {documents}) AS about_doc FROM {events}) e
 JOIN {documents} ON doc_id = about_doc
"""


# Columns of the test tables that the views and queries use.
_SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz, "
    "o_orderpriority string",
    "customer": "c_custkey bigint, c_nationkey int, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string",
    "documents": "doc_id bigint, text string",
    "pages": "page_id bigint, url string, html string",
}


def _spark_sql(template: str, stamp: str) -> str:
    for name, pattern in _SPARK_PATTERNS.items():
        template = template.replace(f"<{name}>", f"date_format({stamp}, '{pattern}')")
    return template


def _duckdb_sql(template: str, stamp: str, tables: list[str]) -> str:
    for name, pattern in _DUCKDB_PATTERNS.items():
        template = template.replace(f"<{name}>", f"strftime({stamp}, '{pattern}')")
    for table in tables:
        template = template.replace(f"{{{table}}}", table)
    return template.replace("AS STRING", "AS VARCHAR")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """With a given schema, which saves a job that reads footers."""
    return spark.read.schema(_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def complaints_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = {t: table(spark, sf_dir, t) for t in ("orders", "customer", "nation", "region")}
    return spark.sql(_spark_sql(_MONTHLY, "o_orderdate"), **frames)


def complaints_daily(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """With ``spread`` the join keeps a number of partitions that busies all cores.

    Spark sizes its partitions by what is shuffled, a text once, and so leaves about one per core, the last ones alone. That
    suits writers; work on every narrative wants more.
    """
    frames, feed = {t: table(spark, sf_dir, t) for t in ("events", "documents")}, _DAILY
    if spread:
        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
        # The other side of the join follows.
        frames["spread"] = frames["documents"].repartition(parts, "doc_id")
        feed = feed.replace("JOIN {documents}", "JOIN {spread}")
    return spark.sql(_spark_sql(feed, "ts"), **frames)


COMPLAINTS_MONTHLY_SQL = _duckdb_sql(_MONTHLY, "o_orderdate", ["orders", "customer", "nation", "region"])
COMPLAINTS_DAILY_SQL = _duckdb_sql(_DAILY, "ts", ["events", "documents"])
