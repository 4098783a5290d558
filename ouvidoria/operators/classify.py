"""Three-level classification of narratives, routing and replies.

The default scorer is a keyword lexicon inside Catalyst: narrow, no shuffle, no Python. A text is
searched once for words that begin like the lexicon's; these alone are lower-cased, tokenised and cut
to the vocabulary, and only this short list is compared with the labels. Categories and subcategories
are looked up under the chosen macro.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ouvidoria.operators import taxonomy

_HITS = "_hits"

# Fixed value: the status that asks for a second reply.
UNRESOLVED = "Não Resolvido"


_LABELS = "array<struct<rank: int, label: string, words: array<string>>>"


def _constant(value: list | dict, schema: str) -> Column:
    """A nested constant in one expression, which Catalyst folds into a literal."""
    return F.from_json(F.lit(json.dumps(value, ensure_ascii=False)), schema)


def fold(text: Column) -> Column:
    """Lower case without accents, as ``taxonomy.folded`` has it: one translation of single characters."""
    accents = dict(sorted(taxonomy.accented_letters().items(), key=lambda pair: not pair[1]))
    return F.translate(F.lower(text), "".join(accents), "".join(accents.values()))


# Letters that stay one letter when lower-cased or folded: a word of them alone is known by its first ones.
_LATIN = "".join(c for c in map(chr, range(0x41, 0x100)) if c.isalpha() and c not in "ªµº")
_BREAKS = "".join(f"\\x{i:02x}" for i in range(0x80) if not chr(i).isalpha())
# What may be, or become, a part of a word: İ is lower-cased to a letter and a mark, and Java and ICU know different letters.
_WORD_PARTS = r"\p{L}\p{M}\p{Cn}"
# Letters by which a word is recognised, and first letters that are tried together.
_BEGINNING, _TOGETHER = 4, 4


def _class(letters: set[str], folded: bool) -> str:
    return "[" + "".join(c for c in _LATIN if _word(c.lower(), folded) in letters) + "]"


def _begins_like(words: list[str], folded: bool) -> str:
    """Pattern of words that have, place by place, beginnings of these; short ones as they are."""
    long = [w for w in words if len(w) >= _BEGINNING]
    places = ["".join(_class({w[i] for w in long}, folded) for i in range(_BEGINNING))] if long else []
    short = ["".join(_class({c}, folded) for c in w) + f"(?![{_LATIN}])" for w in words if len(w) < _BEGINNING]
    return "(?:" + "|".join([*places, *short]) + ")"


def _candidate_pattern(vocabulary: list[str], folded: bool) -> str:
    """Pattern whose group is the next word that may be in the vocabulary, or nothing at the end of a text.

    Passed over are breaks and plain Latin words that begin unlike every word of the vocabulary; any other word
    is left to the exact comparison. Possessive, so that a text is read once.
    """
    words = [w for w in vocabulary if all(_word(c, folded) == c and c in _LATIN for c in w)]
    firsts = sorted({w[0] for w in words})
    groups = [firsts[i : i + _TOGETHER] for i in range(0, len(firsts), _TOGETHER)]
    by_first = "|".join(
        f"(?={_class(set(group), folded)})(?:"
        + "|".join(_begins_like([w for w in words if w[0] == c], folded) for c in group) + ")"
        for group in groups
    )
    other = rf"(?!(?={_begins_like(words, folded)})(?:{by_first}))[{_LATIN}]+(?:[{_BREAKS}]+|(?![{_WORD_PARTS}]))"
    return rf"(?:{other}|[^{_WORD_PARTS}]+)*+([{_WORD_PARTS}]*)"


def lexicon_candidates(text: Column, folded: bool = False) -> Column:
    """The words of a text that may be lexicon words, joined by blanks; the others hit nothing. Null text, null."""
    pattern = _candidate_pattern(_vocabulary(folded), folded)
    return F.array_join(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), " ")


def lexicon_hits(text: Column, folded: bool = False) -> Column:
    """Lexicon words that occur in a text as whole words, case (and, folded, accents) ignored."""
    candidates = lexicon_candidates(text, folded)
    letters = fold(candidates) if folded else F.lower(candidates)
    return F.array_intersect(_constant(_vocabulary(folded), "array<string>"), F.split(letters, r"[^\p{L}]+"))


def _vocabulary(folded: bool) -> list[str]:
    return list(dict.fromkeys(_word(w, folded) for words in taxonomy.macro_keywords().values() for w in words))


def _word(word: str, folded: bool) -> str:
    return taxonomy.folded(word) if folded else word


def _words(words_of: dict[str, list[str]], folded: bool) -> dict[str, list[str]]:
    return {label: list(dict.fromkeys(_word(w, folded) for w in words)) for label, words in words_of.items()}


def _label_table(labels: list[str], words_of: dict[str, list[str]]) -> list[dict]:
    """A later label has a lower rank."""
    return [{"rank": -i, "label": label, "words": words_of[label]} for i, label in enumerate(labels)]


def _best_label(table: Column, hits: Column) -> Column:
    """Label with most words hit, the first one among equals; none hit gives the fallback."""
    scored = F.transform(
        table,
        lambda entry: F.struct(
            F.size(F.array_intersect(entry["words"], hits)).alias("score"),
            entry["rank"].alias("rank"),
            entry["label"].alias("label"),
        ),
    )
    best = F.array_max(F.filter(scored, lambda s: s["score"] > 0))
    return F.when(hits.isNotNull(), F.coalesce(best["label"], F.lit(taxonomy.FALLBACK)))


def _macro_label(hits: Column, folded: bool) -> Column:
    words = _words(taxonomy.macro_keywords(), folded)
    return _best_label(_constant(_label_table(taxonomy.MACROS, words), _LABELS), hits)


def _child_label(children: dict[str, list[str]], macro: Column, hits: Column, folded: bool) -> Column:
    tables = {
        parent: _label_table(labels, _words({label: taxonomy.keywords(label) for label in labels}, folded))
        for parent, labels in children.items()
    }
    return _best_label(F.try_element_at(_constant(tables, f"map<string, {_LABELS}>"), macro), hits)


def classify(df: DataFrame, text: str = "relato", folded: bool = False) -> DataFrame:
    """Add ``macro_categoria``, ``categoria`` and ``subcategoria``; a null text gets nulls.

    ``folded`` compares words without their accents: ``cartao`` and ``COBRANCA`` are words of the lexicon then.
    """
    hits, macro = F.col(_HITS), F.col("macro_categoria")
    return (
        df.withColumn(_HITS, lexicon_hits(F.col(text), folded))
        .withColumn("macro_categoria", _macro_label(hits, folded))
        .withColumns(
            {
                "categoria": _child_label(taxonomy.categorias_of(), macro, hits, folded),
                "subcategoria": _child_label(taxonomy.subcategorias_of(), macro, hits, folded),
            }
        )
        .drop(_HITS)
    )


def route(df: DataFrame, macro: str = "macro_categoria") -> DataFrame:
    """Channel, priority and deadline by exact macro; unknown and null take the default row."""
    names = ["canal", "prioridade", "sla_dias"]

    row = "struct<" + ", ".join(f"{n}: string" for n in names) + ">"
    table = _constant({m: dict(zip(names, v, strict=True)) for m, v in taxonomy.ROUTING.items()}, f"map<string, {row}>")
    default = _constant(dict(zip(names, taxonomy.ROUTING_DEFAULT, strict=True)), row)
    chosen = F.coalesce(F.try_element_at(table, F.col(macro)), default)
    return df.withColumns({n: chosen[n] for n in names})


def suggest_reply(df: DataFrame) -> DataFrame:
    """First reply, at most four lines: topic, responsible channel and deadline. Null text, null reply."""
    return df.withColumn(
        "resposta_sugerida",
        F.when(
            F.col("relato").isNotNull(),
            F.concat(
                F.lit("O relato sobre "), F.col("subcategoria"), F.lit(" ("), F.col("categoria"),
                F.lit(") merece atenção e foi registrado em "), F.col("macro_categoria"), F.lit(".\n"),
                F.lit("A apuração fica com "), F.col("canal"), F.lit(", em prioridade "), F.col("prioridade"),
                F.lit(".\nO retorno com a solução ocorre em até "), F.col("sla_dias"), F.lit(" dias úteis."),
            ),
        ),
    )


def reanalysis_reply(df: DataFrame) -> DataFrame:
    """Second reply for unresolved cases, at most five lines, else ``''``.

    A missing narrative, score or comment makes it null, as nothing could be answered.
    """
    comment = F.trim(F.regexp_replace(F.col("comentario"), "[ \n\r\t]+", " "))
    reply = F.concat(
        F.lit("A insatisfação com o atendimento sobre "), F.col("categoria"), F.lit(" (avaliação: "), F.col("nota"),
        F.lit(") é legítima.\nComentário considerado: "), comment,
        F.lit("\nO caso de "), F.col("macro_categoria"), F.lit(" será reavaliado desde o início por "), F.col("canal"),
        F.lit(".\nUm novo parecer, com as medidas adotadas, será enviado em até "), F.col("sla_dias"),
        F.lit(" dias úteis."),
    )
    return df.withColumn(
        "resposta_final",
        F.when(F.col("status") == UNRESOLVED, F.when(F.col("relato").isNotNull(), reply)).otherwise(F.lit("")),
    )


def classified_daily(bronze: DataFrame) -> DataFrame:
    """Daily rows with the eight added columns, by the lexicon."""
    return (
        bronze.transform(classify).transform(route).transform(suggest_reply).transform(reanalysis_reply)
    )
