import re

import pytest
from pyspark.sql import functions as F

from ouvidoria.operators import classify as C
from ouvidoria.operators import taxonomy as X

TEXTS = [
    "Golpe por mensagem: minha CONTA foi invadida", "Cobrança duplicada na fatura", "PIX não concluído\ne sem estorno",
    "", "nada disso aqui", None, "Cartao clonado", "cartão clonado", "Juros abusivos, juros, JUROS", "x" * 5000 + " login",
    "contas bloqueadas", "Atendimento-ineficiente/demora", "conta bloqueada; saldo indisponível", "appa app2 app",
]


def brute_force(text):
    """The rule word by word, without Spark."""
    if text is None:
        return None, None, None
    words = set(re.findall(r"[^\W\d_]+", text.lower()))

    def best(labels, words_of):
        scores = [(len(words & set(words_of(label))), -i, label) for i, label in enumerate(labels)]
        top = max(scores) if scores else (0,)
        return top[2] if top[0] else X.FALLBACK

    macro = best(X.MACROS, X.macro_keywords().get)
    return macro, best(X.categorias_of()[macro], X.keywords), best(X.subcategorias_of()[macro], X.keywords)


def labels(df):
    out = C.classify(df)
    return {r.relato: (r.macro_categoria, r.categoria, r.subcategoria) for r in out.collect()}


def test_label_sets():
    assert (len(X.MACROS), len(X.CATEGORIAS), len(X.SUBCATEGORIAS)) == (12, 38, 24)
    assert sum(map(len, X.categorias_of().values())) == 38 and sum(map(len, X.subcategorias_of().values())) == 24
    assert X.categorias_of()["Outros"] == ["Outros"]


def test_matches_brute_force(spark, sf_dir):
    documents = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    df = spark.createDataFrame([(t,) for t in TEXTS + documents], "relato string")
    assert labels(df) == {t: brute_force(t) for t in TEXTS + documents}


def test_some_known_labels(spark):
    got = labels(spark.createDataFrame([(t,) for t in TEXTS], "relato string"))
    assert got["cartão clonado"][0] == "Fraudes e Segurança" and got["nada disso aqui"] == ("Outros",) * 3
    assert got[None] == (None, None, None)
    assert got["contas bloqueadas"] == ("Outros",) * 3  # whole words only


def test_independent_of_partitioning(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS * 3], "relato string")
    assert labels(df.repartition(7)) == labels(df.coalesce(1))


def test_plan_is_narrow_and_splits_a_text_once(spark, plan, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    df = documents.selectExpr("text relato", "'Não Resolvido' status", "lang nota", "source comentario")
    text = plan(C.classified_daily(df))
    assert "Exchange" not in text and "EvalPython" not in text
    assert text.count("split(lower(") == 1  # one tokenising for three levels


def test_routing(spark):
    df = spark.createDataFrame([(m,) for m in [*X.MACROS, "Erro de digitação", None]], "macro_categoria string")
    got = {r.macro_categoria: (r.canal, r.prioridade, r.sla_dias) for r in C.route(df).collect()}
    assert got["Fraudes e Segurança"] == ("Prevenção à Fraude", "Alta", "0")
    assert got["Compliance / Regulatório"] == ("Jurídico / Compliance", "Alta", "0")
    assert got["Cartões"] == ("Backoffice de Cartões", "Média", "3")
    for other in ("Canais Digitais", "Outros", "Erro de digitação", None):
        assert got[other] == ("SAC", "Baixa", "5")


@pytest.fixture
def replied(spark):
    data = [
        ("Golpe", "Não Resolvido", "1", "ruim\n\ndemais"), ("Golpe", "Resolvido", "5", None),
        ("Golpe", "Não Resolvido", None, "c"), (None, "Não Resolvido", "1", "c"), (None, None, None, None),
    ]
    df = spark.createDataFrame(data, "relato string, status string, nota string, comentario string")
    return C.classified_daily(df).collect()


def test_replies(replied):
    assert [r.resposta_final is None for r in replied] == [False, False, True, True, False]
    assert replied[1].resposta_final == "" and replied[4].resposta_final == ""
    assert "ruim demais" in replied[0].resposta_final
    assert [r.resposta_sugerida is None for r in replied] == [False, False, False, True, True]


def test_reply_rules(replied):
    first, second = replied[0].resposta_sugerida, replied[0].resposta_final
    assert len(first.split("\n")) <= 4 and len(second.split("\n")) <= 5
    assert "estamos analisando" not in first.lower()
    assert not re.search(r"\b(eu|nós|meu|nosso|estou|vamos)\b", first.lower())
    assert "insatisfação" in second and "reavaliado" in second


def test_folded_words(spark, plan):
    texts = ["cartao clonado", "COBRANCA INDEVIDA", "Cobrança indevida", "cobrança indevida", "CRÉDITO negado", "ação", None, "", "conta-corrente"]
    df = spark.createDataFrame([(t,) for t in texts], "relato string")
    got = {r.relato: (r.macro_categoria, r.categoria) for r in C.classify(df, folded=True).collect()}
    assert got["cartao clonado"] == ("Fraudes e Segurança", "Cartão clonado") and got[None] == (None, None)
    assert got["COBRANCA INDEVIDA"] == got["Cobrança indevida"] == got["cobrança indevida"] == ("Cobranças e Tarifas", "Cobrança indevida")
    assert got["CRÉDITO negado"][0] == "Crédito e Financiamento" and got["ação"] == ("Outros", "Outros")
    assert labels(df)["cartao clonado"] != got["cartao clonado"]
    assert "Exchange" not in plan(C.classify(df, folded=True))
    letters = "".join(chr(c) for c in range(0x21, 0x250))
    folded = spark.createDataFrame([(letters,)], "t string").select(C.fold(F.col("t"))).first()[0]
    assert "ç" not in folded and "ã" not in folded and "é" not in folded and "ø" in folded


def split_whole(text, folded):
    """Hits by splitting the whole text, as a set."""
    letters = C.fold(text) if folded else F.lower(text)
    vocabulary = sorted({C._word(w, folded) for words in X.macro_keywords().values() for w in words})
    return F.array_sort(F.array_intersect(F.split(letters, r"[^\p{L}]+"), F.array(*map(F.lit, vocabulary))))


@pytest.mark.parametrize("folded", [False, True])
def test_candidates_lose_no_hit(spark, folded):
    """Any character before, between and after lexicon words, which may part them, join them or become a letter."""
    around = spark.range(1, 0x110000).where("id not between 55296 and 57343")
    c = F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "utf-32")
    texts = F.array(
        F.concat(F.lit("conta"), c, F.lit("fraude x"), c, F.lit("AR app"), c),
        F.concat(c, F.lit("Cartão the"), c, F.lit(" "), c, F.lit("pix limi"), c, F.lit("te")),
    )
    texts = around.select(F.explode(texts).alias("t"))
    words = sorted({w for ws in X.macro_keywords().values() for w in ws})
    more = [(t,) for w in words for t in (w, w.upper(), w + "s", "x" + w, w[:-1], f"1{w}2", f"the {w}.", f"{w}\u0301", w[:2] + "\u0303" + w[2:])]
    texts = texts.union(spark.createDataFrame([*more, (None,), ("",), ("é" * 300_000 + " pix",), ("a b. " * 300_000 + "login",)], "t string"))
    found = texts.select("t", F.array_sort(C.lexicon_hits(F.col("t"), folded)).alias("found"), split_whole(F.col("t"), folded).alias("all"))
    assert found.where(~F.col("found").eqNullSafe(F.col("all"))).collect() == []
    assert found.where(F.size("found") > 0).count() > 1_000_000


@pytest.mark.parametrize("folded", [False, True])
def test_words_unlike_the_lexicon_are_passed_over(spark, folded):
    text = "Die Würde, the quick (brown) fox: the Conta, o cartão - 12 weeks wow\nPIX app apps zzz Ωmega"
    df = spark.createDataFrame([(text,), ("",), (None,)], "t string")
    words = [r[0] if r[0] is None else r[0].split() for r in df.select(C.lexicon_candidates(F.col("t"), folded)).collect()]
    assert words == [["Conta", "cartão", "PIX", "app", "Ωmega"], [], None]
