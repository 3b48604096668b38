"""Text keys and JSON cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accented Latin letters and their plain form, in the same order.
ACCENTED = "àâäáãåçéèêëíìîïñóòôöõúùûüýÿ"
PLAIN = "aaaaaaceeeeiiiinooooouuuuyy"

_ACCENT_SQL = ACCENTED, PLAIN


def fold(text: Column) -> Column:
    """Lower case without accents."""
    return F.translate(F.lower(text), *_ACCENT_SQL)


def name_key(text: Column) -> Column:
    """Comparable name: no accents, lower case, punctuation reduced to one space."""
    return F.trim(F.regexp_replace(fold(text), "[^a-z0-9]+", " "))


def code_key(text: Column, suffix: str = "-RETENUE") -> Column:
    """Stable code: upper case without accents, the suffix removed, other signs to `_`."""
    upper = F.regexp_replace(F.upper(F.trim(fold(text))), suffix + "$", "")
    return F.trim(F.regexp_replace(upper, "[^A-Z0-9]+", "_"), F.lit("_"))


def day_in_label(text: Column) -> Column:
    """First `dd/MM/yyyy` found in a text, as a date; null without one."""
    found = F.regexp_extract(text, r"(\d{2}/\d{2}/\d{4})", 1)
    return F.try_to_date(F.when(found != "", found), "dd/MM/yyyy")


def empty_to_null(text: Column, empty: tuple[str, ...] = ("", "null", "undefined")) -> Column:
    return F.when(~text.isin(*empty), text)


def detail_json(struct: Column) -> Column:
    """JSON text of a struct whose fields are declared in sorted order; nulls are kept."""
    return F.to_json(struct, {"ignoreNullFields": "false"})
