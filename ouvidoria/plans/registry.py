"""Registered queries: every operator over the whole test tables."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from functools import partial, reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ouvidoria import schemas as S
from ouvidoria.functions import dates, text
from ouvidoria.operators import classify, conform, distinct, gold, incremental, scoring, taxonomy
from ouvidoria.operators.answers import AnswerStore
from ouvidoria.plans import chains, dashboard, sql_api
from ouvidoria.plans.fixtures import complaints_daily, complaints_monthly, table
from ouvidoria.session import cut_lineage, scratch_path
from ouvidoria.sources import feeds, pages, split_csv
from ouvidoria.sources.commit import Commit, Commits
from ouvidoria.sources.tables import Warehouse
from ouvidoria.streaming import daily_feed

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered queries.
MONTHLY_REF, DAILY_REF = "1996-03", "20240110"
MARK = "2024-01-20 12:00:00"
BANKS = ["Santander", "Banco do Brasil", "B7"]
MONTHS = ["1995-02", "1996-03", "1999-12"]
DAYS = ["05/01/2024", "06/01/2024"]
LINK_TEXT = "the"
MODEL = "m1"
EXPORT_BYTES = 400_000
# What one task should read of a multi-line file.
READ_BYTES = 128 << 20

_REGISTRY: dict[str, Query] = {}


def _query(fn: Query) -> Query:
    _REGISTRY[fn.__name__] = fn
    return fn


def registered() -> dict[str, Query]:
    return dict(_REGISTRY)


# -- shared inputs ----------------------------------------------------------------------------


def silver(spark: SparkSession, sf: str) -> DataFrame:
    return conform.silver_monthly(complaints_monthly(spark, sf))


def classified(spark: SparkSession, sf: str) -> DataFrame:
    return classify.classified_daily(conform.of_institution(complaints_daily(spark, sf, spread=True)))


_GOLDS: dict[str, tuple[Query, Callable[[DataFrame], DataFrame]]] = {
    "grupoproblema": (silver, gold.grupo_problema),
    "mediaavaliacao": (silver, gold.media_avaliacao),
    "mediaresposta": (silver, gold.media_resposta),
    "reclamacaotopten": (silver, gold.reclamacao_top_ten),
    "reclamacaouf": (silver, gold.reclamacao_uf),
    "ai_status": (classified, gold.ai_status),
    "ai_nota": (classified, gold.ai_nota),
    "ai_macro_categoria": (classified, gold.ai_macro_categoria),
}
_SPECS = {spec.name: spec for spec in S.GOLD_TABLES}


def gold_frame(spark: SparkSession, sf: str, name: str) -> DataFrame:
    feed, aggregate = _GOLDS[name]
    return _SPECS[name].conform(aggregate(feed(spark, sf)))


def dataset_frame(spark: SparkSession, sf: str, name: str) -> DataFrame:
    gold_name, build = dashboard.DATASETS[name]
    return build(gold_frame(spark, sf, gold_name))


def widget_frame(spark: SparkSession, sf: str, name: str) -> DataFrame:
    widget = dashboard.WIDGETS[name]
    return dashboard.render(dataset_frame(spark, sf, widget.dataset), widget)


for _name in _GOLDS:
    _REGISTRY[f"gold_{_name}"] = partial(gold_frame, name=_name)
for _name in dashboard.DATASETS:
    _REGISTRY[_name] = partial(dataset_frame, name=_name)
for _name in dashboard.WIDGETS:
    _REGISTRY[_name] = partial(widget_frame, name=_name)


def new_warehouse(spark: SparkSession, label: str) -> Warehouse:
    """Databases and files of their own for each call, under the shared folder."""
    wh = Warehouse(spark, scratch_path(spark, label), f"t{uuid.uuid4().hex[:12]}_")
    wh.create()
    return wh


# -- feeds and tables -------------------------------------------------------------------------


@_query
def bronze_monthly(spark, sf):
    return S.BRONZE_MONTHLY.conform(complaints_monthly(spark, sf))


@_query
def bronze_daily(spark, sf):
    return S.BRONZE_DAILY.conform(complaints_daily(spark, sf))


@_query
def csv_scan_monthly(spark, sf):
    path = scratch_path(spark, "basecompleta")
    feeds.write_feed(complaints_monthly(spark, sf), path, S.MONTHLY_FIELDS, feeds.MONTHLY_SEP, slices=True)
    scanned = feeds.read_sliced_feed(spark, path, S.MONTHLY_FIELDS, feeds.MONTHLY_SEP, multi_line=False)
    return S.BRONZE_MONTHLY.conform(scanned)


@_query
def csv_load_monthly(spark, sf):
    """One load that came as two exports with one prefix, from files to its bronze slice."""
    root, wh = scratch_path(spark, "landing"), new_warehouse(spark, "csv_load")
    load = complaints_monthly(spark, sf).where(F.col(S.SLICE_KEY) == MONTHLY_REF)
    first = F.coalesce(F.col("uf"), F.lit("")) < "N"
    for part, rows in enumerate((load.where(first), load.where(~first)), 1):
        path = f"{root}/basecompleta{MONTHLY_REF}_{part}.csv"
        feeds.write_feed(rows, path, S.MONTHLY_FIELDS, feeds.MONTHLY_SEP, null_text=None)
    chains.load_bronze_monthly(wh, root, MONTHLY_REF)
    return wh.table(S.BRONZE_MONTHLY)


@_query
def csv_scan_daily(spark, sf):
    path = scratch_path(spark, "reclamacoes")
    feeds.write_feed(complaints_daily(spark, sf), path, S.DAILY_FIELDS, feeds.DAILY_SEP, slices=True, compression="gzip")
    scanned = feeds.read_sliced_feed(spark, path, S.DAILY_FIELDS, feeds.DAILY_SEP)
    return S.BRONZE_DAILY.conform(scanned)


@_query
def csv_scan_daily_split(spark, sf):
    """The same files, by splits: no file is one task because of the line ends in its narratives."""
    path = scratch_path(spark, "reclamacoes_split")
    feeds.write_feed(complaints_daily(spark, sf), path, S.DAILY_FIELDS, feeds.DAILY_SEP, slices=True)
    scanned = split_csv.read_split_feed(spark, path, S.DAILY_FIELDS, feeds.DAILY_SEP, feeds.NULL_TEXT)
    ref = F.regexp_extract("file", rf"{S.SLICE_KEY}=(\d{{8}})", 1)
    return S.BRONZE_DAILY.conform(scanned.withColumn(S.SLICE_KEY, ref))


@_query
def csv_export_roundtrip(spark, sf):
    """The producer's form, squeezed: separators replaced, further columns left out, no null marker."""
    path = scratch_path(spark, "export")
    df = complaints_daily(spark, sf)
    df = df.withColumns({c: text.protect_separator(F.col(c)) for c in ("relato", "resposta", "nota", "comentario")})
    feeds.write_feed(df, path, S.DAILY_FIELDS, feeds.DAILY_SEP, null_text=None, bytes_per_file=READ_BYTES, compression="gzip")
    return feeds.read_daily(spark, path).toDF(*[c.lower() for c in S.DAILY_FIELDS])


@_query
def csv_export_bounded(spark, sf):
    """Files of at most so many bytes of text and one record, squeezed; a record never lies in two of them."""
    path = scratch_path(spark, "export_bounded")
    feeds.write_bounded(complaints_daily(spark, sf), path, S.DAILY_FIELDS, feeds.DAILY_SEP, EXPORT_BYTES, compression="lz4")
    rows = feeds.read_daily(spark, path, feeds.NULL_TEXT).select("*", "_metadata.file_path", "_metadata.file_size")
    line = feeds.line_bytes(S.DAILY_FIELDS, feeds.DAILY_SEP)
    files = rows.groupBy("file_path", "file_size").agg(F.sum(line).alias("lines"), F.max(line).alias("longest"))
    text = F.col("lines") + feeds.header_bytes(S.DAILY_FIELDS, feeds.DAILY_SEP)
    beyond = files.where(F.greatest("file_size", text) > EXPORT_BYTES + F.col("longest"))
    # None is expected: what is joined to the rows are names of files that broke the bound.
    beyond = F.broadcast(cut_lineage(beyond.select("file_path", F.lit(False).alias("held"))))
    within = F.coalesce("held", F.lit(True)).alias("within")
    return rows.join(beyond, "file_path", "left").select(*[F.col(n).alias(n.lower()) for n in S.DAILY_FIELDS], within)


@_query
def slice_scan(spark, sf):
    wh = new_warehouse(spark, "slice_scan")
    wh.replace(S.BRONZE_MONTHLY, complaints_monthly(spark, sf))
    return wh.slice(S.BRONZE_MONTHLY, MONTHLY_REF)


@_query
def slice_scan_like(spark, sf):
    wh = new_warehouse(spark, "slice_scan_like")
    wh.replace(S.BRONZE_DAILY, complaints_daily(spark, sf), rebalance=False)
    return wh.slice_like(S.BRONZE_DAILY, DAILY_REF, "nomeempresa", "%Santander%")


def _slice_totals(df: DataFrame) -> DataFrame:
    return df.groupBy(S.SLICE_KEY).agg(
        F.count("*").alias("n"), F.sum("notaconsumidor").alias("sum_nota"), F.sum("temporesposta").alias("sum_tempo")
    )


@_query
def slice_replace_idempotent(spark, sf):
    """All slices twice, then one of them a third time: the same as once."""
    wh, rows = new_warehouse(spark, "slice_replace"), silver(spark, sf)
    wh.replace(S.SILVER_MONTHLY, rows)
    wh.replace(S.SILVER_MONTHLY, rows)
    wh.replace(S.SILVER_MONTHLY, rows.where(F.col(S.SLICE_KEY) == MONTHLY_REF), MONTHLY_REF)
    return _slice_totals(wh.table(S.SILVER_MONTHLY))


@_query
def slice_replace_empty(spark, sf):
    """A load without rows empties its slice and leaves the others."""
    wh, rows = new_warehouse(spark, "slice_empty"), silver(spark, sf)
    wh.replace(S.SILVER_MONTHLY, rows)
    wh.replace(S.SILVER_MONTHLY, rows.where(F.col("gestor").isNull()), MONTHLY_REF)
    return _slice_totals(wh.table(S.SILVER_MONTHLY))


@_query
def backfill_emptied_slice(spark, sf):
    """A load that comes again with no row of the financial sector loses its silver and gold slices."""
    wh, feed = new_warehouse(spark, "backfill_emptied"), complaints_monthly(spark, sf)
    chains.backfill_monthly(wh, feed)
    again = feed.where(F.col(S.SLICE_KEY) == MONTHLY_REF).withColumn("area", F.lit("Telefonia"))
    chains.backfill_monthly(wh, again)
    return _slice_totals(wh.table(S.SILVER_MONTHLY))


@_query
def slice_replace_recovered(spark, sf):
    """Silver and its golds by commits, of which one crashes before its switch and one while it is applied."""
    wh, rows = new_warehouse(spark, "slice_recovered"), silver(spark, sf)
    tables = {_SPECS[name]: name for name in ("grupoproblema", "mediaavaliacao", "mediaresposta", "reclamacaotopten", "reclamacaouf")}

    def frames(rows: DataFrame) -> dict[S.TableSpec, DataFrame]:
        golds = gold.monthly_golds(cut_lineage(gold.monthly_rollup(rows)))
        return {S.SILVER_MONTHLY: rows} | {spec: golds[name] for spec, name in tables.items()}

    commits = Commits(wh)
    old = frames(rows.where(F.col("sexo") == "F"))
    commits.replace(old)
    lost = Commit(commits)
    lost.stage(old)
    half = Commit(commits)
    half.stage(frames(rows))
    half.switch()
    commits.apply(half.moves[: len(half.moves) // 2])
    Commits(wh).recover()
    return _slice_counts(wh, [S.SILVER_MONTHLY, *tables])


def _slice_counts(wh: Warehouse, specs: list[S.TableSpec]) -> DataFrame:
    counts = [
        wh.table(spec).groupBy(S.SLICE_KEY).agg(F.count("*").alias("n")).select(F.lit(spec.name).alias("table_name"), S.SLICE_KEY, "n")
        for spec in specs
    ]
    return reduce(DataFrame.unionAll, counts)


@_query
def slice_append(spark, sf):
    """The append mode doubles a slice when it runs again."""
    wh, rows = new_warehouse(spark, "slice_append"), silver(spark, sf)
    wh.append(S.SILVER_MONTHLY, rows)
    wh.append(S.SILVER_MONTHLY, rows)
    return _slice_totals(wh.table(S.SILVER_MONTHLY))


def _table_counts(wh: Warehouse, specs: list[S.TableSpec]) -> DataFrame:
    counts = [
        wh.table(spec).agg(F.count("*").alias("n")).select(
            F.lit(spec.database).alias("database_name"), F.lit(spec.name).alias("table_name"), "n"
        )
        for spec in specs
    ]
    return reduce(DataFrame.unionAll, counts)


@_query
def catalog_create(spark, sf):
    """Twelve tables created twice over, the two bronze ones loaded."""
    wh = new_warehouse(spark, "catalog")
    wh.create()
    wh.replace(S.BRONZE_MONTHLY, complaints_monthly(spark, sf))
    wh.replace(S.BRONZE_DAILY, complaints_daily(spark, sf), rebalance=False)
    return _table_counts(wh, S.ALL_TABLES)


@_query
def catalog_drop(spark, sf):
    """Dropping removes the catalog entries; the files of external tables stay."""
    wh = new_warehouse(spark, "catalog_drop")
    wh.replace(S.BRONZE_MONTHLY, complaints_monthly(spark, sf))
    wh.drop()
    left = sum(spark.catalog.databaseExists(f"{wh.prefix}{d}") for d in (S.BRONZE, S.SILVER, S.GOLD))
    files = spark.read.parquet(wh.location(S.BRONZE_MONTHLY.path_suffix))
    return files.agg(F.count("*").alias("rows_in_files")).withColumn("databases_left", F.lit(left).cast("bigint"))


@_query
def monthly_chain(spark, sf):
    """Bronze to gold, all loads, every table written."""
    wh = new_warehouse(spark, "monthly_chain")
    chains.backfill_monthly(wh, complaints_monthly(spark, sf))
    return _table_counts(wh, [S.BRONZE_MONTHLY, S.SILVER_MONTHLY, *S.GOLD_TABLES[:5]])


@_query
def daily_chain(spark, sf):
    wh = new_warehouse(spark, "daily_chain")
    chains.backfill_daily(wh, complaints_daily(spark, sf), rebalance=False)
    return _table_counts(wh, [S.BRONZE_DAILY, S.SILVER_DAILY, *S.GOLD_TABLES[5:]])


@_query
def daily_stream_ingest(spark, sf):
    """Files to the bronze table by a stream that stops when it has caught up; run twice."""
    wh, root = new_warehouse(spark, "stream"), scratch_path(spark, "feed")
    checkpoint = scratch_path(spark, "stream_checkpoint")
    feeds.write_feed(complaints_daily(spark, sf), root, S.DAILY_FIELDS, feeds.DAILY_SEP, slices=True, compression="gzip")
    for _ in range(2):
        daily_feed.ingest_available(wh, root, checkpoint, daily_feed.EXPORTED, feeds.NULL_TEXT).awaitTermination()
    return wh.table(S.BRONZE_DAILY)


@_query
def daily_stream_redelivery(spark, sf):
    """All days, then one of them again under its old name with other texts; a third run finds nothing to do."""
    wh, root = new_warehouse(spark, "redelivery"), scratch_path(spark, "redelivered")
    checkpoint = scratch_path(spark, "redelivery_checkpoint")
    feed = complaints_daily(spark, sf)
    again = feed.where(F.col(S.SLICE_KEY) == DAILY_REF).where(F.col("nomeempresa") == "Nubank")
    for delivered in (feed, again.withColumn("status", F.lit("Reaberto")), None):
        if delivered is not None:
            feeds.deliver_days(delivered, root, compression="gzip")
        daily_feed.ingest_available(wh, root, checkpoint, null_text=feeds.NULL_TEXT).awaitTermination()
    return wh.table(S.BRONZE_DAILY)


# -- conformance and text ---------------------------------------------------------------------


@_query
def silver_conform(spark, sf):
    return conform.conform(complaints_monthly(spark, sf))


@_query
def silver_rejects(spark, sf):
    """What did not parse, by column, raw value and load."""
    rows = conform.conform_with_rejects(complaints_monthly(spark, sf))
    found = conform.rejects(rows)
    return found.groupBy("column", "value", S.SLICE_KEY).agg(F.count("*").alias("n"))


@_query
def silver_financial(spark, sf):
    return silver(spark, sf)


@_query
def nota_digits(spark, sf):
    nota = F.col("nota")
    return (
        complaints_daily(spark, sf)
        .groupBy(nota, text.digits_only(nota).alias("digitos"), text.parse_score(nota).alias("valor"))
        .agg(F.count("*").alias("n"))
    )


@_query
def institution_label(spark, sf):
    name = F.col("nomefantasia")
    return (
        complaints_monthly(spark, sf)
        .groupBy(name, text.institution_label(name).alias("banco"))
        .agg(F.count("*").alias("n"))
    )


@_query
def label_cleanup(spark, sf):
    answer = F.concat(F.lit('"'), F.col("text"), F.lit('"\n'))
    return table(spark, sf, "documents").select(
        "doc_id",
        text.clean_label(answer, text.MACRO_WIDTH).alias("macro_categoria"),
        text.clean_label(answer, text.CATEGORIA_WIDTH).alias("categoria"),
        text.clean_label(answer, text.SUBCATEGORIA_WIDTH).alias("subcategoria"),
    )


@_query
def location_split(spark, sf):
    place = F.concat(F.col("dataocorrido"), F.lit(", "), F.col("cidade"), F.lit(" - "), F.col("uf"))
    parts = {n: c.alias(n) for n, c in text.location_parts(place).items()}
    positional = {n: c.alias(f"{n}_posicional") for n, c in text.location_parts_positional(place).items()}
    columns = [*parts.values(), *positional.values()]
    names = [*parts, *[f"{n}_posicional" for n in positional]]
    return complaints_daily(spark, sf).select(*columns).groupBy(*names).agg(F.count("*").alias("n"))


@_query
def text_sanitize(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id",
        text.strip_parentheses(F.col("text")).alias("sem_parenteses"),
        text.protect_separator(F.col("text")).alias("sem_separador"),
    )


@_query
def deinterleave(spark, sf):
    shown = table(spark, sf, "pages").select("page_id", pages.shown(F.col("html")).alias("html"))
    listed = shown.select("page_id", pages.element_texts(F.col("html"), "p").alias("items"))
    lists = {"nota": text.every_other(F.col("items"), 0), "comentario": text.every_other(F.col("items"), 1)}
    return pages.zip_shortest(listed, lists).drop("items")


@_query
def url_to_key(spark, sf):
    url = text.plain_http(F.col("url"))
    return table(spark, sf, "pages").select("page_id", url.alias("url"), text.landing_key(url).alias("chave"))


@_query
def counter_parse(spark, sf):
    shown = F.concat(F.lit("Resultados desde "), F.date_format("ts", "dd/MM/yyyy, HH:mm:ss"))
    return table(spark, sf, "events").select("event_id", dates.counter_timestamp(shown).alias("desde"))


@_query
def default_load_ref(spark, sf):
    day = F.col("o_orderdate").cast("date")
    explicit = F.when(F.col("o_orderkey") % 3 == 0, F.lit("2000-01")).otherwise(F.lit(" "))
    return table(spark, sf, "orders").select(
        "o_orderkey", dates.monthly_ref(day, explicit).alias("ref_mensal"), dates.daily_ref(day).alias("ref_diaria")
    )


@_query
def html_link_discovery(spark, sf):
    return pages.find_links(table(spark, sf, "pages"), "html", containing=LINK_TEXT)


@_query
def html_link_class(spark, sf):
    """Links of the download class only, in listings made of the pages: every third anchor has the class among others."""
    styles = F.array(F.lit("btn"), F.lit(f"btn {pages.LISTING_CLASS} big"), F.lit(f"{pages.LISTING_CLASS}-not"))
    link = F.concat(F.lit("https://h/base"), F.col("page_id"), F.lit(".csv?a=1&amp;b="), F.col("page_id") % 7)
    anchor = F.concat(
        F.lit("<a class='"), F.element_at(styles, (F.col("page_id") % 3 + 1).cast("int")), F.lit("' href=\""), link, F.lit("\">x</a>")
    )
    listings = table(spark, sf, "pages").select("page_id", F.concat(F.col("html"), anchor).alias("html"))
    return pages.find_links(listings, "html", css_class=pages.LISTING_CLASS)


@_query
def html_record_extract(spark, sf):
    html = F.col("html")
    anchors = F.filter(pages.elements(html, "a"), lambda a: pages.attribute(a, "href").isNotNull())
    lists = {
        "link": F.transform(anchors, lambda a: pages.attribute(a, "href")),
        "titulo": F.transform(anchors, pages.element_text),
        "paragrafo": pages.element_texts(html, "p"),
    }
    return pages.extract_records(table(spark, sf, "pages"), "html", lists)


def _escaped(c):
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(char), F.lit(entity))
    return c


@_query
def portal_records(spark, sf):
    """Results pages around the daily complaints: links in narratives, entities, unclosed and void tags."""
    place = F.concat_ws("", "dataocorrido", F.lit(", "), "cidade", F.lit(" - "), "uf")
    card = F.concat(
        F.lit("<div class='card'><div class='x relatos-nome-empresa'><a href=#>"), _escaped(F.col("nomeempresa")),
        F.lit("</a> <a>mais</a></div><div><h4>"), _escaped(F.col("status")),
        F.lit("</h4><input disabled></div><div><span>"), place, F.lit("</span><p>veja <a href=x>&eacute;</a><br> "),
        _escaped(F.col("relato")), F.lit("</div><div><span>("), F.col("temporesposta"), F.lit(")</span><p>sim &amp; n<b>&atilde;o</b></p></div><div><p>"),
        _escaped(F.col("nota")), F.lit("<p>fim<!-- <p>nada</p> --></p></div></div>"),
    )
    columns = ("nomeempresa", "status", "cidade", "uf", "relato", "temporesposta", "nota")
    daily = complaints_daily(spark, sf).fillna("", list(columns))
    found = pages.portal_records(daily.select(F.concat(F.lit("<html><ul><li>"), card).alias("page")), "page")
    return found.select(
        F.col("nomeEmpresa").alias("nomeempresa"), "status", F.md5("Relato").alias("relato_md5"),
        F.col("Resposta").alias("resposta"), F.col("Nota").alias("nota"), F.col("Comentario").alias("comentario"),
    ).groupBy("nomeempresa", "status", "relato_md5", "resposta", "nota", "comentario").agg(F.count("*").alias("n"))


# -- classification ---------------------------------------------------------------------------


def _labels(spark, sf, *columns: str) -> DataFrame:
    return classify.classify(complaints_daily(spark, sf, spread=True)).select(F.md5("relato").alias("relato_md5"), *columns)


@_query
def classify_macro(spark, sf):
    return _labels(spark, sf, "macro_categoria")


@_query
def classify_categoria(spark, sf):
    return _labels(spark, sf, "macro_categoria", "categoria")


@_query
def classify_subcategoria(spark, sf):
    return _labels(spark, sf, "macro_categoria", "categoria", "subcategoria")


@_query
def classify_macro_folded(spark, sf):
    """Narratives that lost their accents and case on the way are classified like the others."""
    daily = complaints_daily(spark, sf, spread=True).withColumn("original", F.md5("relato"))
    bare = daily.withColumn("relato", F.upper(classify.fold(F.col("relato"))))
    return classify.classify(bare, folded=True).select(
        F.col("original").alias("relato_md5"), "macro_categoria", "categoria", "subcategoria"
    )


def _routed(spark, sf, column: str) -> DataFrame:
    return classified(spark, sf).groupBy("macro_categoria", column).agg(F.count("*").alias("n"))


for _name, _column in {"route_canal": "canal", "route_prioridade": "prioridade", "route_sla": "sla_dias"}.items():
    _REGISTRY[_name] = partial(_routed, column=_column)


@_query
def reply_suggested(spark, sf):
    return classified(spark, sf).groupBy("resposta_sugerida").agg(F.count("*").alias("n"))


@_query
def reply_reanalysis(spark, sf):
    return classified(spark, sf).groupBy("status", "resposta_final").agg(F.count("*").alias("n"))


@_query
def daily_classified(spark, sf):
    return S.SILVER_DAILY.conform(classified(spark, sf))


@_query
def batch_score(spark, sf):
    """The model hook with a stand-in scorer."""

    def length(texts: pd.Series) -> pd.Series:
        return texts.str.len()

    # The digest of the result is made where the narratives are, so that rows take none back with their answers.
    narratives = complaints_daily(spark, sf).select("relato", F.md5("relato").alias("relato_md5"))
    return scoring.batch_score(narratives, "relato", length, "pontos", "bigint").select("relato_md5", "pontos")


def _stand_in(prompts: pd.Series, model: str) -> pd.Series:
    """Deterministic answers: a macro category by the prompt's digest, else a text that names the digest."""
    digests = prompts.map(lambda p: hashlib.md5(p.encode()).hexdigest())
    macros = taxonomy.MACROS
    chosen = digests.map(lambda d: f'"{macros[int(d[:2], 16) % len(macros)]}"\n')
    return chosen.where(prompts.str.startswith("Escolha"), f"{model}: " + digests)


@_query
def classified_by_model(spark, sf):
    """The model chain twice with one store: the second run takes every answer from it."""
    daily = conform.of_institution(complaints_daily(spark, sf))
    store = AnswerStore.temporary(spark)
    scoring.classified_daily_by_model(daily, _stand_in, MODEL, store)

    def refuse(prompts: pd.Series, model: str) -> pd.Series:
        raise RuntimeError(f"asked again: {len(prompts)} prompts")

    return S.SILVER_DAILY.conform(scoring.classified_daily_by_model(daily, refuse, MODEL, store))


@_query
def model_prompts(spark, sf):
    """What the model is asked, with the lexicon's labels in place of its own."""
    rows, c = classified(spark, sf), F.col
    labels = [c("macro_categoria"), c("categoria"), c("subcategoria")]
    prompts = {
        "macro": scoring.macro_prompt(c("relato")),
        "categoria": scoring.categoria_prompt(c("relato"), *labels[:1]),
        "subcategoria": scoring.subcategoria_prompt(c("relato"), *labels[:2]),
        "resposta": scoring.reply_prompt(c("relato"), *labels),
        "reanalise": scoring.reanalysis_prompt(c("relato"), c("nota"), c("comentario"), *labels[:2]),
    }
    hashed = rows.select(*[F.md5(prompt).alias(name) for name, prompt in prompts.items()])
    return hashed.groupBy(*prompts).agg(F.count("*").alias("n"))


# -- cross-filters ----------------------------------------------------------------------------


def _facets(golds: dict[str, DataFrame], name: str, datasets: list[str], selections: dashboard.Selections) -> DataFrame:
    """The facet over every dataset of one feed."""
    parts = []
    for dataset in datasets:
        gold_name, build = dashboard.DATASETS[dataset]
        rows = build(_SPECS[gold_name].conform(golds[gold_name]))
        parts.append(dashboard.facet(rows, name, selections).withColumn("dataset", F.lit(dataset)))
    return reduce(DataFrame.unionByName, parts)


def _monthly_golds(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """All monthly golds from one scan of the feed; what is checkpointed are group counts."""
    return gold.monthly_golds(cut_lineage(gold.monthly_rollup(silver(spark, sf))))


def _daily_golds(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return gold.daily_golds(cut_lineage(gold.daily_rollup(classified(spark, sf))))


_MONTHLY_DATASETS = ["ds_reclamacao", "ds_mediaresposta", "ds_mediaavaliacao", "ds_reclamacaouf"]
_DAILY_DATASETS = ["ds_macro_categoria", "ds_nota", "ds_status"]


@_query
def cross_filter(spark, sf):
    selections = {"Banco": BANKS, "Ano_Mes": MONTHS, "Data_Ocorrido": DAYS}
    return dashboard.cross_filter(dataset_frame(spark, sf, "ds_reclamacaouf"), selections)


@_query
def widget_sql(spark, sf):
    """Every widget by its SQL function, filtered: one row for each of its rows, as JSON."""
    wh = new_warehouse(spark, "widget_sql")
    monthly, daily = _monthly_golds(spark, sf), _daily_golds(spark, sf)
    wh.replace_many({_SPECS[name]: df for name, df in (monthly | daily).items()})
    sql_api.install(wh)
    chosen = f"array({', '.join(repr(m) for m in MONTHS)})"
    parts = [
        spark.sql(f"SELECT '{name}' AS widget, to_json(struct(*), map('ignoreNullFields', 'false')) AS valores FROM {wh.prefix}{name}(meses => {chosen})")
        for name in dashboard.WIDGETS
    ]
    return reduce(DataFrame.unionAll, parts)


@_query
def kpi_total_categorias_filtered(spark, sf):
    """Distinct categories under several filters, each from the stored state alone."""
    path = scratch_path(spark, "category_state")
    distinct.category_state(gold_frame(spark, sf, "ai_macro_categoria")).write.parquet(path)
    state = spark.read.schema(f"{S.SLICE_KEY} string, {distinct.DAY} string, known binary, others array<string>").parquet(path)
    load, day = F.col(S.SLICE_KEY) == DAILY_REF, F.col(distinct.DAY).isin(DAYS)
    filters = {"todos": F.lit(True), "carga": load, "dias": day, "carga e dias": load & day, "carga ou dias": load | day}
    parts = [distinct.distinct_categories(state.where(f)).withColumn("filtro", F.lit(name)) for name, f in filters.items()]
    return reduce(DataFrame.unionByName, parts)


@_query
def facet_banco(spark, sf):
    return _facets(_monthly_golds(spark, sf), "Banco", _MONTHLY_DATASETS, {"Banco": BANKS, "Ano_Mes": MONTHS})


@_query
def facet_ano_mes(spark, sf):
    return _facets(_monthly_golds(spark, sf), "Ano_Mes", _MONTHLY_DATASETS, {"Banco": BANKS, "Ano_Mes": MONTHS})


@_query
def facet_data_ocorrido(spark, sf):
    return _facets(_daily_golds(spark, sf), "Data_Ocorrido", _DAILY_DATASETS, {"Banco": BANKS})


# -- incremental ------------------------------------------------------------------------------


def paged_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events as records of result pages of one hundred; the counter is a page's oldest time."""
    page = Window.partitionBy("page_id")
    return (
        table(spark, sf, "events")
        .select("event_id", "ts", F.expr("event_id div 100").alias("page_id"))
        .withColumn("page_ts", F.min("ts").over(page))
    )


@_query
def frontier_pages(spark, sf):
    kept = incremental.frontier(paged_events(spark, sf), MARK)
    return kept.groupBy("page_id", "page_ts").agg(F.count("*").alias("n"))


@_query
def hwm_next(spark, sf):
    """Two runs with a stored mark: the first sees the pages up to ``MARK`` and emits nothing, the second sees all."""
    records, path = paged_events(spark, sf), scratch_path(spark, "emitted")
    store = incremental.MarkStore(spark, scratch_path(spark, "mark"))
    sink = lambda df: df.select("event_id", "ts").write.mode("append").parquet(path)
    known = records.where(F.col("page_ts") <= F.lit(MARK).cast("timestamp_ntz"))
    incremental.run_increment(known, store, sink, record_level=False)
    mark = store.read()
    moved = incremental.run_increment(records, store, sink, record_level=False)
    emitted = spark.read.schema("event_id bigint, ts timestamp_ntz").parquet(path) if moved else records.where("false")
    as_mark = lambda m: F.lit(m and m.isoformat(sep=" ")).cast("timestamp_ntz")
    return emitted.agg(F.count("*").alias("emitted"), F.max("ts").alias("newest")).select(
        as_mark(mark).alias("mark"), as_mark(store.read()).alias("next_mark"), F.lit(moved).alias("moved"), "emitted", "newest"
    )


@_query
def incremental_gate(spark, sf):
    records = paged_events(spark, sf)
    current = incremental.current_mark(records)
    return incremental.gate(incremental.frontier(records, MARK), MARK, current).select("event_id", "page_id", "ts")


@_query
def incremental_first_run(spark, sf):
    """No mark yet: nothing is emitted, the newest counter becomes the mark."""
    records = paged_events(spark, sf)
    current = incremental.current_mark(records)
    emitted = incremental.gate(records, None, current)
    return emitted.agg(F.count("*").alias("emitted")).withColumn("next_mark", current)


@_query
def incremental_records(spark, sf):
    return incremental.newer_than(table(spark, sf, "events"), MARK).select("event_id", "ts")
