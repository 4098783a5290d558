"""The registered queries in DuckDB SQL, built from shared common table expressions.

Classification is written another way than in Spark, as joins with a keyword table.
"""

from __future__ import annotations

import re

from ouvidoria.functions.text import BANK_WORD, FULL_NAME_BANKS
from ouvidoria.operators import taxonomy
from ouvidoria.plans import registry
from ouvidoria.plans.fixtures import COMPLAINTS_DAILY_SQL, COMPLAINTS_MONTHLY_SQL
from ouvidoria.schemas import ALL_TABLES, BR_DATE_COLUMNS, DAILY_FIELDS, GOLD_TABLES, INT_COLUMNS, MONTHLY_FIELDS


def _quote(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _in(values: list[str]) -> str:
    return "(" + ", ".join(_quote(v) for v in values) + ")"


def _date(c: str) -> str:
    return (
        f"CASE WHEN regexp_matches({c}, '^\\d{{2}}/\\d{{2}}/\\d{{4}}$') "
        f"THEN CAST(try_strptime({c}, '%d/%m/%Y') AS DATE) END"
    )


def _int(c: str) -> str:
    return f"CASE WHEN regexp_matches({c}, '^\\s*[+-]?\\d+\\s*$') THEN TRY_CAST(trim({c}) AS INTEGER) END"


def _conformed(source: str, where: str = "true") -> str:
    columns = []
    for name in [n.lower() for n in MONTHLY_FIELDS]:
        if name in BR_DATE_COLUMNS:
            columns.append(f"{_date(name)} AS {name}")
        elif name == "datafinalizacao":
            columns.append(f"TRY_CAST({name} AS DATE) AS {name}")
        elif name in INT_COLUMNS:
            columns.append(f"{_int(name)} AS {name}")
        elif name in ("procurouempresa", "respondida"):
            columns.append(f"coalesce({name} = 'S', false) AS {name}")
        else:
            columns.append(name)
    return f"SELECT {', '.join(columns)}, datrefcarga FROM {source} WHERE {where}"


def _lexicon_rows() -> str:
    """(level, parent, position, label, word)."""
    rows = []
    levels = [
        (1, {"": taxonomy.MACROS}, taxonomy.macro_keywords()),
        (2, taxonomy.categorias_of(), None),
        (3, taxonomy.subcategorias_of(), None),
    ]
    for level, children, words in levels:
        for parent, labels in children.items():
            for i, label in enumerate(labels):
                for word in words[label] if words else taxonomy.keywords(label):
                    rows.append(f"({level}, {_quote(parent)}, {i}, {_quote(label)}, {_quote(word)})")
    return ", ".join(rows)


_HALF_UP = "floor(({total} * {scale} * 2 + {n}) / (2.0 * {n})) / {scale}.0"
_PLAIN_LABEL = (
    f"if(list_contains([{', '.join(map(_quote, FULL_NAME_BANKS))}], trim(nomefantasia)), nomefantasia, "
    f"trim(replace(nomefantasia, {_quote(BANK_WORD)}, '')))"
)


def _mean(total: str, n: str, digits: int) -> str:
    return _HALF_UP.format(total=total, n=n, scale=10**digits)


def _best(level: int, parent: str) -> str:
    """Per narrative: the label with most distinct words, the earlier one among equals."""
    return (
        "SELECT id, label FROM ("
        " SELECT w.id, l.label, row_number() OVER (PARTITION BY w.id ORDER BY count(*) DESC, l.position) AS r"
        f" FROM words w JOIN lexicon l ON l.word = w.word AND l.level = {level} {parent}"
        " GROUP BY w.id, l.label, l.position) WHERE r = 1"
    )


_MACRO_CASE = {
    column: "CASE macro_categoria "
    + " ".join(f"WHEN {_quote(m)} THEN {_quote(v[i])}" for m, v in taxonomy.ROUTING.items())
    + f" ELSE {_quote(taxonomy.ROUTING_DEFAULT[i])} END"
    for i, column in enumerate(("canal", "prioridade", "sla_dias"))
}

_CTES: dict[str, str] = {
    "monthly": COMPLAINTS_MONTHLY_SQL,
    "daily": COMPLAINTS_DAILY_SQL,
    "silver": _conformed("monthly", "nomefantasia LIKE 'Banco%' AND area = 'Serviços Financeiros'"),
    "g_grupoproblema": "SELECT nomefantasia, grupoproblema, datrefcarga, count(nomefantasia) AS qtdreclamcoes "
    "FROM silver GROUP BY ALL",
    "g_mediaavaliacao": f"SELECT nomefantasia, datrefcarga, {_mean('sum(notaconsumidor)', 'count(nomefantasia)', 2)} "
    'AS "mediaAvaliacao" FROM silver WHERE notaconsumidor IS NOT NULL GROUP BY ALL',
    "g_mediaresposta": f"SELECT nomefantasia, datrefcarga, {_mean('sum(temporesposta)', 'count(nomefantasia)', 0)} "
    'AS "mediaRespostaDias" FROM silver WHERE respondida GROUP BY ALL',
    "g_reclamacaotopten": "SELECT nomefantasia, datrefcarga, count(nomefantasia) AS qtdreclamcoes FROM silver "
    "GROUP BY nomefantasia, datrefcarga QUALIFY row_number() OVER (PARTITION BY datrefcarga "
    "ORDER BY count(nomefantasia) DESC, nomefantasia) <= 10",
    "g_reclamacaouf": "SELECT nomefantasia, 'Brasil - ' || uf AS uf, datrefcarga, count(nomefantasia) AS "
    '"qtdReclamcoesUf" FROM silver GROUP BY ALL',
    "lexicon": f"SELECT * FROM (VALUES {_lexicon_rows()}) AS t(level, parent, position, label, word)",
    "keyed": "SELECT *, md5(relato) AS id FROM daily",
    "words": "SELECT id, word FROM (SELECT id, unnest(list_distinct(string_split_regex(lower(relato), "
    "'[^\\p{L}]+'))) AS word FROM (SELECT DISTINCT id, relato FROM keyed WHERE relato IS NOT NULL)) "
    "WHERE word IN (SELECT word FROM lexicon)",
    "best_macro": _best(1, ""),
    "macros": "SELECT n.id, coalesce(b.label, 'Outros') AS macro FROM "
    "(SELECT DISTINCT id FROM keyed WHERE id IS NOT NULL) n LEFT JOIN best_macro b ON b.id = n.id",
    "best_categoria": _best(2, "JOIN macros m ON m.id = w.id AND m.macro = l.parent"),
    "best_subcategoria": _best(3, "JOIN macros m ON m.id = w.id AND m.macro = l.parent"),
    "labelled": "SELECT d.*, m.macro AS macro_categoria, "
    "CASE WHEN d.id IS NOT NULL THEN coalesce(c.label, 'Outros') END AS categoria, "
    "CASE WHEN d.id IS NOT NULL THEN coalesce(s.label, 'Outros') END AS subcategoria FROM keyed d "
    "LEFT JOIN macros m ON m.id = d.id LEFT JOIN best_categoria c ON c.id = d.id "
    "LEFT JOIN best_subcategoria s ON s.id = d.id",
    "routed": "SELECT *, " + ", ".join(f"{case} AS {name}" for name, case in _MACRO_CASE.items())
    + " FROM labelled WHERE nomeempresa LIKE '%Santander%'",
    "classified": "SELECT *, CASE WHEN relato IS NOT NULL THEN 'O relato sobre ' || subcategoria || ' (' || categoria "
    "|| ') merece atenção e foi registrado em ' || macro_categoria || '.' || chr(10) || 'A apuração fica com ' "
    "|| canal || ', em prioridade ' || prioridade || '.' || chr(10) || 'O retorno com a solução ocorre em até ' "
    "|| sla_dias || ' dias úteis.' END AS resposta_sugerida, "
    "CASE WHEN status = 'Não Resolvido' THEN CASE WHEN relato IS NOT NULL THEN "
    "'A insatisfação com o atendimento sobre ' || categoria || ' (avaliação: ' || nota || ') é legítima.' || chr(10) "
    "|| 'Comentário considerado: ' || trim(regexp_replace(comentario, '[ \\n\\r\\t]+', ' ', 'g')) || chr(10) "
    "|| 'O caso de ' || macro_categoria || ' será reavaliado desde o início por ' || canal || '.' || chr(10) "
    "|| 'Um novo parecer, com as medidas adotadas, será enviado em até ' || sla_dias || ' dias úteis.' END "
    "ELSE '' END AS resposta_final FROM routed",
    "g_ai_status": "SELECT status, dataocorrido, datrefcarga, count(*) AS qtd FROM daily "
    "WHERE nomeempresa LIKE '%Santander%' GROUP BY ALL",
    "g_ai_nota": "SELECT regexp_replace(upper(nota), '[^0-9]', '', 'g') AS nota, dataocorrido, datrefcarga, "
    "count(*) AS qtd FROM daily WHERE nomeempresa LIKE '%Santander%' GROUP BY ALL",
    "g_ai_macro_categoria": "SELECT macro_categoria, dataocorrido, datrefcarga, count(*) AS qtd FROM routed "
    "GROUP BY ALL",
    "ds_reclamacao": f'SELECT {_PLAIN_LABEL} AS "Banco", qtdreclamcoes AS "Qtd_Reclamacoes", '
    'datrefcarga AS "Ano_Mes" FROM g_reclamacaotopten',
    "ds_mediaresposta": f'SELECT {_PLAIN_LABEL} AS "Banco", "mediaRespostaDias" AS "Media_Resposta_Dias", '
    'datrefcarga AS "Ano_Mes" FROM g_mediaresposta',
    "ds_mediaavaliacao": f'SELECT {_PLAIN_LABEL} AS "Banco", "mediaAvaliacao" AS "Media_Avaliacao", '
    'datrefcarga AS "Ano_Mes" FROM g_mediaavaliacao',
    "ds_reclamacaouf": f"SELECT {_PLAIN_LABEL} AS \"Banco\", trim(replace(uf, 'Brasil - ', '')) AS \"UF\", "
    '"qtdReclamcoesUf" AS "Qtd_Reclamacoes_UF", datrefcarga AS "Ano_Mes" FROM g_reclamacaouf',
    "ds_macro_categoria": f'SELECT macro_categoria AS "Macro_Categoria", {_date("dataocorrido")} AS "Data_Ocorrido", '
    'qtd AS "Qtd" FROM g_ai_macro_categoria',
    "ds_nota": f'SELECT nota AS "Nota", {_date("dataocorrido")} AS "Data_Ocorrido", qtd AS "Qtd", '
    'TRY_CAST(nota AS INTEGER) * qtd AS "Nota_Ponderada" FROM g_ai_nota '
    "WHERE nota <> '' AND regexp_matches(nota, '^[0-9]+$')",
    "ds_status": f'SELECT status AS "Status", {_date("dataocorrido")} AS "Data_Ocorrido", qtd AS "Qtd" FROM g_ai_status',
    "paged": "SELECT event_id, ts, event_id // 100 AS page_id, min(ts) OVER (PARTITION BY event_id // 100) AS page_ts "
    "FROM events",
    "frontier": f"SELECT * FROM paged WHERE page_ts >= (SELECT coalesce(max(page_ts) FILTER "
    f"(WHERE page_ts <= TIMESTAMP '{registry.MARK}'), min(page_ts)) FROM paged)",
}

def _with(body: str) -> str:
    """Prefix ``body`` with the expressions it needs, directly or not."""
    needed: set[str] = set()

    def visit(sql: str) -> None:
        words = set(_identifiers(sql))
        for name in _ORDER:
            if name in words and name not in needed:
                needed.add(name)
                visit(_CTES[name])

    visit(body)
    parts = [f"{name} AS ({_CTES[name]})" for name in _ORDER if name in needed]
    return f"WITH {', '.join(parts)} {body}" if parts else body


def _identifiers(sql: str) -> list[str]:
    """Names after FROM and JOIN."""
    tokens = re.sub(r"'[^']*'", "''", sql).replace("(", " ( ").replace(")", " ) ").replace(",", " , ").split()
    return [tokens[i + 1] for i, t in enumerate(tokens[:-1]) if t.upper() in ("FROM", "JOIN")]


def _sum(column: str, source: str, dims: tuple[str, ...] = ()) -> str:
    keys = "".join(f'"{d}", ' for d in dims)
    group = f" GROUP BY {', '.join(map(_name, dims))}" if dims else ""
    return f'SELECT {keys}CAST(sum("{column}") AS BIGINT) AS "sum({column})" FROM {source}{group}'


def _name(column: str) -> str:
    return f'"{column}"'


def _avg(column: str, source: str) -> str:
    return (
        f'SELECT CAST(sum(CAST("{column}" AS DECIMAL(18, 2))) AS DOUBLE) / count("{column}") AS "avg({column})" '
        f"FROM {source}"
    )


def _facet(name: str, datasets: list[str], condition: str = "true") -> str:
    return " UNION ALL ".join(
        f"SELECT '{d}' AS dataset, \"{name}\", count(*) FILTER (WHERE {condition}) AS \"{name}_associativity\" "
        f'FROM {d} GROUP BY "{name}"'
        for d in datasets
    )


def _counts(tables: list[tuple[str, str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{db}' AS database_name, '{name}' AS table_name, count(*) AS n FROM {source}"
        for db, name, source in tables
    )


_SLICE_TOTALS = (
    "SELECT datrefcarga, {times} * count(*) AS n, CAST({times} * sum(notaconsumidor) AS BIGINT) AS sum_nota, "
    "CAST({times} * sum(temporesposta) AS BIGINT) AS sum_tempo FROM silver {where} GROUP BY datrefcarga"
)
_DAILY_COLUMNS = ", ".join(c.lower() for c in DAILY_FIELDS)
_BY_MONTH = f'"Ano_Mes" IN {_in(registry.MONTHS)}'
_BY_LOAD, _BY_DAY = f"datrefcarga = '{registry.DAILY_REF}'", f"dataocorrido IN {_in(registry.DAYS)}"
_BY_BANK = f'"Banco" IN {_in(registry.BANKS)}'

def _plain(fragment: str) -> str:
    """Visible text of a fragment: tags out, the entities that markup needs decoded, blanks collapsed."""
    text = f"regexp_replace({fragment}, '<[^>]*>', '', 'g')"
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")):
        text = f"replace({text}, '{entity}', '{char}')"
    return f"trim(regexp_replace({text}, '\\s+', ' ', 'g'))"


# By splitting instead of matching: what follows each opening tag, up to its end or the next opening.
_PARAGRAPHS = f"list_transform(string_split(html, '<p>')[2:], lambda x: {_plain("split_part(x, '</p>', 1)")})"
_PLACE = r"'^([^,]*),\s*(.*)\s-\s*([^-]*)$'"


def _reclean(width: int) -> str:
    return f"trim(regexp_replace(left('\"' || text || '\"' || chr(10), {width}), '[\\n\\r\"]', '', 'g'))"


def _lines(*lines: str) -> str:
    return " || chr(10) || ".join(map(_quote, lines))


_CATEGORIA_HEAD = _lines(
    ".", "Escolha a categoria do relato, coerente com a macrocategoria, entre as opções seguintes.", *taxonomy.CATEGORIAS,
    "Responda apenas com o nome da opção.", "Relato: ",
)
_SUBCATEGORIA_HEAD = _lines(
    ".", "Escolha a subcategoria mais específica do relato entre as opções seguintes.", *taxonomy.SUBCATEGORIAS,
    "Responda apenas com o nome da opção.", "Relato: ",
)
_MACRO_HEAD = _lines(
    "Escolha a macrocategoria do relato entre as opções seguintes.", *taxonomy.MACROS,
    "Responda apenas com o nome da opção; na dúvida, Outros.", "Relato: ",
)
_REPLY_HEAD = _lines(
    "Escreva a resposta ao cliente em até 4 linhas, com empatia, sem primeira pessoa e sem frases prontas; diga o que será "
    "feito e não invente fatos.", "Macrocategoria: ",
)
_REANALYSIS_HEAD = _lines(
    "O cliente ficou insatisfeito. Escreva nova resposta em até 5 linhas, que reconheça a insatisfação e informe que o caso "
    "será reavaliado, com ação concreta.", "Nota: ",
)
_PROMPTS = {
    "macro": f"{_MACRO_HEAD} || relato",
    "categoria": f"'Macrocategoria: ' || macro_categoria || {_CATEGORIA_HEAD} || relato",
    "subcategoria": "'Macrocategoria: ' || macro_categoria || '.' || chr(10) || 'Categoria: ' || categoria || "
    f"{_SUBCATEGORIA_HEAD} || relato",
    "resposta": f"{_REPLY_HEAD} || macro_categoria || chr(10) || 'Categoria: ' || categoria || chr(10) || "
    "'Subcategoria: ' || subcategoria || chr(10) || 'Relato: ' || relato",
    "reanalise": f"{_REANALYSIS_HEAD} || nota || chr(10) || 'Comentário: ' || comentario || chr(10) || 'Macrocategoria: ' || "
    "macro_categoria || chr(10) || 'Categoria: ' || categoria || chr(10) || 'Relato: ' || relato",
}
_ANSWER = f"'{registry.MODEL}: ' || md5({{prompt}})"
_CTES |= {
    "asked1": f"SELECT *, [{', '.join(map(_quote, taxonomy.MACROS))}]"
    f"[CAST('0x' || substr(md5({_PROMPTS['macro']}), 1, 2) AS INTEGER) % {len(taxonomy.MACROS)} + 1] AS macro_categoria "
    "FROM daily WHERE nomeempresa LIKE '%Santander%'",
    "asked2": f"SELECT *, {_ANSWER.format(prompt=_PROMPTS['categoria'])} AS categoria FROM asked1",
    "asked3": f"SELECT *, {_ANSWER.format(prompt=_PROMPTS['subcategoria'])} AS subcategoria FROM asked2",
    "asked": "SELECT *, " + ", ".join(f"{case} AS {name}" for name, case in _MACRO_CASE.items())
    + f", {_ANSWER.format(prompt=_PROMPTS['resposta'])} AS resposta_sugerida, CASE WHEN status = 'Não Resolvido' "
    f"THEN {_ANSWER.format(prompt=_PROMPTS['reanalise'])} ELSE '' END AS resposta_final FROM asked3",
}
_CTES |= {
    "folded_lexicon": "SELECT DISTINCT level, parent, position, label, strip_accents(word) AS word FROM lexicon",
    "folded_words": "SELECT id, word FROM (SELECT id, unnest(list_distinct(string_split_regex(strip_accents(lower(relato)), "
    "'[^\\p{L}]+'))) AS word FROM (SELECT DISTINCT id, relato FROM keyed WHERE relato IS NOT NULL)) "
    "WHERE word IN (SELECT word FROM folded_lexicon)",
} | {
    name: sql.replace("words w JOIN lexicon l", "folded_words w JOIN folded_lexicon l").replace("macros m", "folded_macros m")
    .replace("best_macro", "folded_best_macro")
    for name, sql in {
        "folded_best_macro": _CTES["best_macro"], "folded_macros": _CTES["macros"],
        "folded_categoria": _CTES["best_categoria"], "folded_subcategoria": _CTES["best_subcategoria"],
    }.items()
}
_ORDER = list(_CTES)


def _bodies() -> dict[str, str]:
    sql: dict[str, str] = {f"gold_{t.name}": f"SELECT * FROM g_{t.name}" for t in GOLD_TABLES}
    sql |= {name: f"SELECT * FROM {name}" for name in _CTES if name.startswith("ds_")}
    sql |= {
        "kpi_total_reclamacoes": _sum("Qtd_Reclamacoes", "ds_reclamacao"),
        "kpi_media_resposta": _avg("Media_Resposta_Dias", "ds_mediaresposta"),
        "kpi_media_avaliacao": _avg("Media_Avaliacao", "ds_mediaavaliacao"),
        "bar_reclamacoes_instituicao": _sum("Qtd_Reclamacoes", "ds_reclamacao", ("Banco",)),
        "bar_reclamacoes_uf": _sum("Qtd_Reclamacoes_UF", "ds_reclamacaouf", ("UF",)),
        "line_reclamacoes_mes": _sum("Qtd_Reclamacoes", "ds_reclamacao", ("Ano_Mes",)),
        "kpi_total_relatos": _sum("Qtd", "ds_macro_categoria"),
        "kpi_nota_media": 'SELECT CAST(sum("Nota_Ponderada") AS DOUBLE) / CAST(sum("Qtd") AS DOUBLE) '
        "AS nota_media_ponderada FROM ds_nota",
        "kpi_total_categorias": 'SELECT count(DISTINCT "Macro_Categoria") AS count_distinct_categorias '
        "FROM ds_macro_categoria",
        "bar_macro_categoria": _sum("Qtd", "ds_macro_categoria", ("Macro_Categoria",)),
        "bar_status": _sum("Qtd", "ds_status", ("Status",)),
        "bar_nota": _sum("Qtd", "ds_nota", ("Nota",)),
        "line_evolucao_macro": _sum("Qtd", "ds_macro_categoria", ("Data_Ocorrido",)),
        "line_evolucao_status": _sum("Qtd", "ds_status", ("Data_Ocorrido", "Status")),
        "line_evolucao_nota": _sum("Qtd", "ds_nota", ("Data_Ocorrido", "Nota")),
    }
    sql |= {
        "bronze_monthly": "SELECT * FROM monthly",
        "bronze_daily": "SELECT * FROM daily",
        "csv_scan_monthly": "SELECT * FROM monthly",
        "csv_load_monthly": "SELECT "
        + ", ".join(f"nullif({c}, '') AS {c}" for c in [n.lower() for n in MONTHLY_FIELDS])
        + f", datrefcarga FROM monthly WHERE datrefcarga = '{registry.MONTHLY_REF}'",
        "csv_scan_daily": "SELECT * FROM daily",
        "csv_scan_daily_split": "SELECT * FROM daily",
        "csv_export_roundtrip": "SELECT "
        + ", ".join(
            f"nullif(replace({c}, '|', ';'), '') AS {c}" if c in ("relato", "resposta", "nota", "comentario") else c
            for c in [n.lower() for n in DAILY_FIELDS]
        )
        + " FROM daily",
        "csv_export_bounded": f"SELECT {', '.join(n.lower() for n in DAILY_FIELDS)}, true AS within FROM daily",
        "slice_scan": f"SELECT * FROM monthly WHERE datrefcarga = '{registry.MONTHLY_REF}'",
        "slice_scan_like": f"SELECT * FROM daily WHERE datrefcarga = '{registry.DAILY_REF}' "
        "AND nomeempresa LIKE '%Santander%'",
        "slice_replace_idempotent": _SLICE_TOTALS.format(times=1, where=""),
        "slice_replace_empty": _SLICE_TOTALS.format(times=1, where=f"WHERE datrefcarga <> '{registry.MONTHLY_REF}'"),
        "backfill_emptied_slice": _SLICE_TOTALS.format(times=1, where=f"WHERE datrefcarga <> '{registry.MONTHLY_REF}'"),
        "slice_replace_recovered": " UNION ALL ".join(
            f"SELECT '{name}' AS table_name, datrefcarga, count(*) AS n FROM {source} GROUP BY datrefcarga"
            for name, source in [("consumidorservicosfinanceiros", "silver"), *((t.name, f"g_{t.name}") for t in GOLD_TABLES[:5])]
        ),
        "slice_append": _SLICE_TOTALS.format(times=2, where=""),
        "catalog_create": _counts(
            [
                (t.database, t.name, {"consumidor": "monthly", "consumidor_dia": "daily"}.get(t.name, "daily WHERE false"))
                for t in ALL_TABLES
            ]
        ),
        "catalog_drop": "SELECT count(*) AS rows_in_files, CAST(0 AS BIGINT) AS databases_left FROM monthly",
        "monthly_chain": _counts(
            [("b_consumidor", "consumidor", "monthly"), ("s_consumidor", "consumidorservicosfinanceiros", "silver")]
            + [(t.database, t.name, f"g_{t.name}") for t in GOLD_TABLES[:5]]
        ),
        "daily_chain": _counts(
            [("b_consumidor", "consumidor_dia", "daily"), ("s_consumidor", "ai_classificacao_relatos", "classified")]
            + [(t.database, t.name, f"g_{t.name}") for t in GOLD_TABLES[5:]]
        ),
        "daily_stream_ingest": "SELECT * FROM daily",
        "daily_stream_redelivery": f"SELECT * FROM daily WHERE datrefcarga <> '{registry.DAILY_REF}' UNION ALL "
        f"SELECT * REPLACE ('Reaberto' AS status) FROM daily WHERE datrefcarga = '{registry.DAILY_REF}' "
        "AND nomeempresa = 'Nubank'",
    }
    sql |= {
        "silver_conform": _conformed("monthly"),
        "silver_rejects": " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", {c} AS value, datrefcarga, count(*) AS n FROM monthly "
            f"WHERE trim({c}) <> '' AND ({typed}) IS NULL GROUP BY ALL"
            for c, typed in [
                *((c, _date(c)) for c in BR_DATE_COLUMNS), ("datafinalizacao", "TRY_CAST(datafinalizacao AS DATE)"),
                *((c, _int(c)) for c in INT_COLUMNS),
            ]
        ),
        "silver_financial": "SELECT * FROM silver",
        "nota_digits": "SELECT nota, regexp_replace(upper(nota), '[^0-9]', '', 'g') AS digitos, "
        "TRY_CAST(replace(nullif(regexp_extract(nota, '(\\d+(?:[.,]\\d+)?)', 1), ''), ',', '.') AS DOUBLE) AS valor, "
        "count(*) AS n FROM daily GROUP BY ALL",
        "institution_label": f"SELECT nomefantasia, {_PLAIN_LABEL} AS banco, count(*) AS n FROM monthly GROUP BY ALL",
        "label_cleanup": f"SELECT doc_id, {_reclean(50)} AS macro_categoria, {_reclean(60)} AS categoria, "
        f"{_reclean(80)} AS subcategoria FROM documents",
        "location_split": "SELECT "
        f"regexp_extract(place, {_PLACE}, 1) AS data, trim(regexp_extract(place, {_PLACE}, 2)) AS cidade, "
        f"trim(regexp_extract(place, {_PLACE}, 3)) AS uf, split_part(place, ',', 1) AS data_posicional, "
        "trim(split_part(split_part(place, ',', 2), '-', 1)) AS cidade_posicional, "
        "trim(split_part(split_part(place, ',', 2), '-', 2)) AS uf_posicional, count(*) AS n "
        "FROM (SELECT dataocorrido || ', ' || cidade || ' - ' || uf AS place FROM daily) GROUP BY ALL",
        "text_sanitize": "SELECT doc_id, replace(replace(text, '(', ''), ')', '') AS sem_parenteses, "
        "replace(text, '|', ';') AS sem_separador FROM documents",
        "deinterleave": "SELECT page_id, max(item) FILTER (WHERE i % 2 = 1) AS nota, "
        "max(item) FILTER (WHERE i % 2 = 0) AS comentario FROM ("
        "SELECT page_id, unnest(items) AS item, generate_subscripts(items, 1) AS i FROM ("
        f"SELECT page_id, {_PARAGRAPHS} AS items FROM pages)) "
        "GROUP BY page_id, (i - 1) // 2 HAVING count(*) = 2",
        "url_to_key": "SELECT page_id, replace(url, 'https', 'http') AS url, "
        "'tmp/' || regexp_extract(replace(url, 'https', 'http'), '([^/]*)$', 1) AS chave FROM pages",
        "counter_parse": "SELECT event_id, date_trunc('second', ts) AS desde FROM events",
        "default_load_ref": "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN '2000-01' "
        "ELSE strftime(o_orderdate - INTERVAL 30 DAY, '%Y-%m') END AS ref_mensal, "
        "strftime(o_orderdate, '%Y%m%d') AS ref_diaria FROM orders",
        "html_link_discovery": "SELECT page_id, url, href FROM (SELECT page_id, url, "
        "replace(unnest(regexp_extract_all(html, '<a href=\"([^\"]*)\"', 1)), '&amp;', '&') AS href FROM pages) "
        f"WHERE href <> '' AND contains(href, '{registry.LINK_TEXT}')",
        "html_link_class": "SELECT page_id, 'https://h/base' || page_id || '.csv?a=1&b=' || page_id % 7 AS href FROM pages "
        "WHERE page_id % 3 = 1",
        "html_record_extract": "SELECT page_id, url, r[1] AS link, r[2] AS titulo, r[3] AS paragrafo FROM ("
        "SELECT page_id, url, unnest(list_zip(list_transform(a, lambda x: replace(split_part(x, '\"', 1), '&amp;', '&')), "
        f"list_transform(a, lambda x: {_plain("substr(split_part(x, '</a>', 1), strpos(x, '>') + 1)")}), {_PARAGRAPHS}, true)) AS r "
        "FROM (SELECT page_id, url, html, string_split(html, '<a href=\"')[2:] AS a FROM pages))",
        "portal_records": "SELECT trim(regexp_replace(coalesce(nomeempresa, ''), '\\s+', ' ', 'g')) AS nomeempresa, "
        "trim(regexp_replace(coalesce(status, ''), '\\s+', ' ', 'g')) AS status, "
        "md5(replace(trim(regexp_replace('veja é ' || coalesce(relato, ''), '\\s+', ' ', 'g')), '|', ';')) AS relato_md5, "
        "'sim & não' AS resposta, trim(coalesce(nota, '')) AS nota, 'fim' AS comentario, count(*) AS n "
        "FROM daily GROUP BY ALL",
    }
    sql |= {
        "classify_macro": "SELECT md5(relato) AS relato_md5, macro_categoria FROM labelled",
        "classify_categoria": "SELECT md5(relato) AS relato_md5, macro_categoria, categoria FROM labelled",
        "classify_subcategoria": "SELECT md5(relato) AS relato_md5, macro_categoria, categoria, subcategoria "
        "FROM labelled",
        "classify_macro_folded": "SELECT d.id AS relato_md5, m.macro AS macro_categoria, CASE WHEN d.id IS NOT NULL THEN "
        "coalesce(c.label, 'Outros') END AS categoria, CASE WHEN d.id IS NOT NULL THEN coalesce(s.label, 'Outros') END AS "
        "subcategoria FROM keyed d LEFT JOIN folded_macros m ON m.id = d.id LEFT JOIN folded_categoria c ON c.id = d.id "
        "LEFT JOIN folded_subcategoria s ON s.id = d.id",
        "route_canal": "SELECT macro_categoria, canal, count(*) AS n FROM routed GROUP BY ALL",
        "route_prioridade": "SELECT macro_categoria, prioridade, count(*) AS n FROM routed GROUP BY ALL",
        "route_sla": "SELECT macro_categoria, sla_dias, count(*) AS n FROM routed GROUP BY ALL",
        "reply_suggested": "SELECT resposta_sugerida, count(*) AS n FROM classified GROUP BY ALL",
        "reply_reanalysis": "SELECT status, resposta_final, count(*) AS n FROM classified GROUP BY ALL",
        "daily_classified": f"SELECT {_DAILY_COLUMNS}, datrefcarga, macro_categoria, categoria, subcategoria, canal, "
        "prioridade, sla_dias, resposta_sugerida, resposta_final FROM classified",
        "classified_by_model": f"SELECT {_DAILY_COLUMNS}, datrefcarga, macro_categoria, categoria, subcategoria, canal, "
        "prioridade, sla_dias, resposta_sugerida, resposta_final FROM asked",
        "model_prompts": f"SELECT {', '.join(f'md5({p}) AS {n}' for n, p in _PROMPTS.items())}, count(*) AS n FROM classified "
        "GROUP BY ALL",
        "batch_score": "SELECT md5(relato) AS relato_md5, length(relato) AS pontos FROM daily",
        "kpi_total_categorias_filtered": " UNION ALL ".join(
            f"SELECT '{name}' AS filtro, count(DISTINCT macro_categoria) AS count_distinct_categorias FROM g_ai_macro_categoria "
            f"WHERE {where}"
            for name, where in {
                "todos": "true", "carga": _BY_LOAD, "dias": _BY_DAY, "carga e dias": f"{_BY_LOAD} AND {_BY_DAY}",
                "carga ou dias": f"{_BY_LOAD} OR {_BY_DAY}",
            }.items()
        ),
        "cross_filter": f"SELECT * FROM ds_reclamacaouf WHERE {_BY_BANK} AND {_BY_MONTH}",
        "facet_banco": _facet("Banco", registry._MONTHLY_DATASETS, _BY_MONTH),
        "facet_ano_mes": _facet("Ano_Mes", registry._MONTHLY_DATASETS, _BY_BANK),
        "facet_data_ocorrido": _facet("Data_Ocorrido", registry._DAILY_DATASETS),
        "frontier_pages": "SELECT page_id, page_ts, count(*) AS n FROM frontier GROUP BY ALL",
        "hwm_next": "SELECT m.mark, n.next_mark, n.next_mark > m.mark AS moved, count(*) AS emitted, max(p.ts) AS newest "
        f"FROM (SELECT max(page_ts) AS mark FROM paged WHERE page_ts <= TIMESTAMP '{registry.MARK}') m, "
        "(SELECT max(page_ts) AS next_mark FROM paged) n, paged p WHERE p.page_ts >= m.mark GROUP BY ALL",
        "incremental_gate": "SELECT event_id, page_id, ts FROM frontier WHERE "
        f"(SELECT max(page_ts) FROM paged) > TIMESTAMP '{registry.MARK}'",
        "incremental_first_run": "SELECT count(*) FILTER (WHERE false) AS emitted, max(page_ts) AS next_mark FROM paged",
        "incremental_records": f"SELECT event_id, ts FROM events WHERE ts > TIMESTAMP '{registry.MARK}'",
    }
    sql["widget_sql"] = " UNION ALL ".join(
        f"SELECT '{name}' AS widget, CAST(to_json(t) AS VARCHAR) AS valores FROM ({_filtered(sql[name])}) t" for name in registry.dashboard.WIDGETS
    )
    return sql


def _filtered(widget: str) -> str:
    """A widget's statement over the chosen months, where its dataset has months."""
    for dataset in ("ds_reclamacaouf", "ds_reclamacao", "ds_mediaresposta", "ds_mediaavaliacao"):
        if f"FROM {dataset}" in widget:
            return widget.replace(f"FROM {dataset}", f"FROM {dataset} WHERE {_BY_MONTH}", 1)
    return widget


def statements() -> dict[str, str]:
    return {name: _with(body) for name, body in _bodies().items()}
