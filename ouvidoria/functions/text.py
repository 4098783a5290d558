"""Text clean-up, labels, locations and URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Institutions that keep their full name, the removed word, the region prefix.
FULL_NAME_BANKS = ["Banco do Brasil", "Banco do Nordeste"]
BANK_WORD = "Banco"
REGION_PREFIX = "Brasil - "

# Longest model answer kept for each level of the taxonomy.
MACRO_WIDTH, CATEGORIA_WIDTH, SUBCATEGORIA_WIDTH = 50, 60, 80


def digits_only(c: Column) -> Column:
    """Drop everything but 0-9: ``'4.5'`` becomes ``'45'``, words become ``''``."""
    return F.regexp_replace(F.upper(c), "[^0-9]", "")


def parse_score(c: Column) -> Column:
    """The first number of a score text as double (``'4,5'`` and ``'Nota 4.5'`` are 4.5)."""
    number = F.regexp_extract(c, r"(\d+(?:[.,]\d+)?)", 1)
    return F.replace(number, F.lit(","), F.lit(".")).try_cast("double")


def institution_label(c: Column) -> Column:
    """Dashboard label of a bank: two keep their name untouched, others lose every 'Banco'."""
    return F.when(F.trim(c).isin(FULL_NAME_BANKS), c).otherwise(
        F.trim(F.replace(c, F.lit(BANK_WORD), F.lit("")))
    )


def region_key(uf: Column) -> Column:
    """Map region key of a state; null stays null."""
    return F.concat(F.lit(REGION_PREFIX), uf)


def region_uf(key: Column) -> Column:
    return F.trim(F.replace(key, F.lit(REGION_PREFIX), F.lit("")))


def clean_label(c: Column, width: int) -> Column:
    """First ``width`` characters, then without line ends and double quotes, then trimmed."""
    return F.trim(F.regexp_replace(F.left(c, F.lit(width)), '[\n\r"]', ""))


def location_parts(c: Column) -> dict[str, Column]:
    """Date, city and state of ``'date, City - UF'``; the last ' - ' parts city and state."""
    shape = r"^([^,]*),\s*(.*)\s-\s*([^-]*)$"
    return {
        "data": F.regexp_extract(c, shape, 1),
        "cidade": F.trim(F.regexp_extract(c, shape, 2)),
        "uf": F.trim(F.regexp_extract(c, shape, 3)),
    }


def location_parts_positional(c: Column) -> dict[str, Column]:
    """The same by position: first comma part, then first and second hyphen part.

    A hyphenated city is cut at its own hyphen; kept for feeds that were loaded that way.
    """
    comma = F.split(c, ",")
    hyphen = F.split(F.get(comma, F.lit(1)), "-")
    return {
        "data": F.get(comma, F.lit(0)),
        "cidade": F.trim(F.get(hyphen, F.lit(0))),
        "uf": F.trim(F.get(hyphen, F.lit(1))),
    }


def strip_parentheses(c: Column) -> Column:
    return F.translate(c, "()", "")


def protect_separator(c: Column) -> Column:
    """The feed separator must not occur inside a value."""
    return F.replace(c, F.lit("|"), F.lit(";"))


def every_other(items: Column, offset: int) -> Column:
    """Items of an array at positions ``offset``, ``offset + 2``, ... (zero-based)."""
    return F.filter(items, lambda _, i: i % 2 == offset)


def plain_http(url: Column) -> Column:
    return F.replace(url, F.lit("https"), F.lit("http"))


def landing_key(url: Column, folder: str = "tmp/") -> Column:
    """Where a downloaded file lands: the part of the URL after its last slash, in ``folder``."""
    return F.concat(F.lit(folder), F.substring_index(url, "/", -1))
