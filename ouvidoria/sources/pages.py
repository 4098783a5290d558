"""Links and records out of HTML pages; a small tolerant reader where records depend on how elements nest."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ouvidoria.functions.text import every_other, location_parts, protect_separator, strip_parentheses

# Fixed value: class of the download links in the data catalogue.
LISTING_CLASS = "resource-url-analytics"

# Where a results page shows each list of the daily feed. The name is the first link in an element of its
# class, the status a heading; the others are children of the third, fourth and fifth <div> among its siblings.
NAME_CLASS = "relatos-nome-empresa"
STATUS_TAG = "h4"
PLACES = {(3, "span"): "place", (4, "span"): "reply_time", (3, "p"): "narrative", (4, "p"): "reply", (5, "p"): "last"}
LISTS = ("name", "status", "place", "reply_time", "narrative", "reply", "last")


def decode_entities(c: Column) -> Column:
    """The named entities that markup itself needs; the ampersand comes last."""
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        c = F.replace(c, F.lit(entity), F.lit(char))
    return c


def element_text(c: Column) -> Column:
    """Visible text of a markup fragment: no tags, entities decoded, blanks collapsed."""
    return F.trim(F.regexp_replace(decode_entities(F.regexp_replace(c, "<[^>]*>", "")), r"\s+", " "))


def shown(c: Column) -> Column:
    """Markup without comments, scripts and styles."""
    return F.regexp_replace(c, r"(?is)<!--.*?(?:-->|\z)|<(script|style)\b.*?(?:</\1\s*>|\z)", "")


def elements(c: Column, tag: str) -> Column:
    """Opening tag and content of every element of a kind in ``shown`` markup; an unclosed one ends where the next begins.

    The markup is cut where an element opens, and each piece where it closes: two linear passes.
    """
    pieces = F.split(c, rf"(?i)<(?={tag}[\s>])")
    opened = F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0)))
    cut = F.transform(opened, lambda p: F.concat(F.lit("<"), F.regexp_replace(p, rf"(?is)</{tag}\s*>.*\z", "")))
    return F.filter(cut, lambda e: e.rlike(rf"(?is)^<{tag}(?:\s[^>]*)?>"))


def attribute(tag: Column, name: str) -> Column:
    """Value of an attribute of an opening tag, in double, single or no quotes; null if it is absent."""
    value = rf"""(?is)^<[^\s>]+(?:\s+(?!{name}\s*=)[^\s=>]+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]+))?)*\s+{name}\s*=\s*"""
    found = F.regexp_extract(tag, value + r"""("[^"]*"|'[^']*'|[^\s"'>]+)""", 1)
    return F.when(found != "", decode_entities(F.regexp_replace(found, r"""^["']|["']$""", "")))


def find_links(
    df: DataFrame,
    html: str,
    containing: str | None = None,
    css_class: str | None = None,
    link: str = "href",
) -> DataFrame:
    """One row per ``<a>`` with a non-empty ``href``, optionally of one class and holding a text.

    Attributes may be quoted either way or not at all; comments and scripts hold no links. Anchors are reduced inside
    the row before they are exploded, so only kept links become rows.
    """
    quoted = r"""(?i)<a\s(?:"[^"]*"|'[^']*'|[^"'>])*>"""
    anchors = F.regexp_extract_all(shown(F.col(html)), F.lit(quoted), F.lit(0))
    if css_class is not None:
        anchors = F.filter(
            anchors, lambda a: F.array_contains(F.split(F.coalesce(attribute(a, "class"), F.lit("")), r"\s+"), css_class)
        )
    kept = F.filter(F.transform(anchors, lambda a: attribute(a, "href")), lambda h: h.isNotNull() & (h != ""))
    if containing is not None:
        kept = F.filter(kept, lambda h: h.contains(containing))
    others = [c for c in df.columns if c != html]
    return df.select(*others, F.explode(kept).alias(link))


def zip_shortest(df: DataFrame, lists: dict[str, Column]) -> DataFrame:
    """Parallel lists to rows, as many as the shortest list has; all other columns stay."""
    others = df.columns
    staged = df.select(*others, *[column.alias(f"_{name}") for name, column in lists.items()])
    sizes = [F.size(f"_{name}") for name in lists]
    shortest = F.least(*sizes) if len(sizes) > 1 else sizes[0]
    sliced = [F.slice(F.col(f"_{name}"), F.lit(1), shortest).alias(name) for name in lists]
    return staged.select(*others, F.inline(F.arrays_zip(*sliced)))


def extract_records(df: DataFrame, html: str, lists: dict[str, Column]) -> DataFrame:
    """Records from pages whose fields are repeated elements: one list of values per field.

    ``lists`` read the ``shown`` markup of the page, which is made once, in a projection of its own. They are matched by
    position and cut to the shortest, as a page may end half way.
    """
    return zip_shortest(df.withColumn(html, shown(F.col(html))), lists).drop(html)


def element_texts(c: Column, tag: str) -> Column:
    """Whole visible text of every element of a kind in ``shown`` markup."""
    return F.transform(elements(c, tag), element_text)


class _Results(HTMLParser):
    """Reads a results page as a browser would: no tag has to be closed, any entity is known, nothing is an error."""

    VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
    BLOCKS = frozenset("div h1 h2 h3 h4 h5 h6 li ol p section table ul".split())
    MUTE = frozenset(("script", "style"))

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lists: dict[str, list[list[str]]] = {name: [] for name in LISTS}
        # Open elements: tag, place among sibling <div>s, number of child <div>s, own text if it is listed, name wanted.
        self.open: list[list] = [["", 0, 0, None, False]]

    def handle_starttag(self, tag, attrs):
        if tag in self.VOID:
            return self.handle_data(" ")
        if tag in self.BLOCKS and self.open[-1][0] == "p" or tag == "li" and self.open[-1][0] == "li":
            self.open.pop()
        parent = self.open[-1]
        if tag == "div":
            parent[2] += 1
        place = parent[2] if tag == "div" else 0
        wants = NAME_CLASS in (dict(attrs).get("class") or "").split()
        name = PLACES.get((parent[1], tag)) if parent[0] == "div" else None
        if tag == STATUS_TAG:
            name = "status"
        if tag == "a":
            asking = next((e for e in reversed(self.open) if e[4]), None)
            if asking:
                asking[4], name = False, "name"
        own = None
        if name:
            own = []
            self.lists[name].append(own)
        self.open.append([tag, place, 0, own, wants])

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in self.VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i][0] == tag:
                del self.open[i:]
                return

    def handle_data(self, data):
        if self.open[-1][0] not in self.MUTE:
            for element in self.open:
                if element[3] is not None:
                    element[3].append(data)


def read_results(html: str | None) -> dict[str, list[str]]:
    """The lists of one results page, each item with its blanks collapsed."""
    page = _Results()
    page.feed(html or "")
    page.close()
    return {name: [" ".join("".join(t).split()) for t in found] for name, found in page.lists.items()}


def _results(html: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([read_results(h) for h in html], columns=list(LISTS))


def portal_records(df: DataFrame, html: str) -> DataFrame:
    """The ten daily fields from results pages.

    Every element gives its whole text, whatever stands inside it, so records keep their place. As many records follow
    as the shortest list of a page has.
    """
    lists_of = F.pandas_udf(_results, ", ".join(f"{name} array<string>" for name in LISTS))
    read = df.withColumn("_page", lists_of(F.coalesce(F.col(html), F.lit(""))))
    found = {name: F.col(f"_page.{name}") for name in LISTS}
    places = F.transform(found["place"], lambda t: F.struct(*[c.alias(n) for n, c in location_parts(t).items()]))
    last = F.transform(found["last"], protect_separator)
    lists = {
        "nomeEmpresa": found["name"],
        "status": found["status"],
        "tempoResposta": F.transform(found["reply_time"], strip_parentheses),
        "dataOcorrido": F.transform(places, lambda p: p["data"]),
        "Cidade": F.transform(places, lambda p: p["cidade"]),
        "UF": F.transform(places, lambda p: p["uf"]),
        "Relato": F.transform(found["narrative"], protect_separator),
        "Resposta": F.transform(found["reply"], protect_separator),
        "Nota": every_other(last, 0),
        "Comentario": every_other(last, 1),
    }
    return zip_shortest(read, lists).drop(html, "_page")
