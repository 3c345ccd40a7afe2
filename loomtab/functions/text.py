"""Text normalisation as column expressions; only NFKC needs an Arrow function."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Spaces that count as a plain one, and signs without width (fixed values).
EXOTIC_SPACES = "      "
ZERO_WIDTH = "​‌‍﻿­"


def nfkc(c: Column) -> Column:
    """Compatibility composition, the one step without a built-in function."""

    def compose(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: unicodedata.normalize("NFKC", t), na_action="ignore")

    return F.pandas_udf(compose, "string")(c)


def nfkc_each(c: Column) -> Column:
    """The same for each text of an array; higher-order functions can't call Python."""

    def compose(arrays: pd.Series) -> pd.Series:
        return arrays.map(lambda ts: [t if t is None else unicodedata.normalize("NFKC", t) for t in ts], na_action="ignore")

    return F.pandas_udf(compose, "array<string>")(c)


def tidy_text(c: Column) -> Column:
    """Exotic spaces as spaces; zero-width and control signs removed (tabs and line ends too); trimmed, lower case, single spaces."""
    c = F.translate(c, EXOTIC_SPACES, " " * len(EXOTIC_SPACES))
    c = F.regexp_replace(c, f"[{ZERO_WIDTH}]", "")
    c = F.regexp_replace(c, r"[\x00-\x1f\x7f]", "")
    return F.regexp_replace(F.lower(F.regexp_replace(c, r"(?U)^\s+|(?<!\s)\s++$", "")), r"(?U)\s+", " ")


def normalize_text(c: Column) -> Column:
    """NFKC and :func:`tidy_text`; NULL stays NULL."""
    return tidy_text(nfkc(c))


def singularize(c: Column) -> Column:
    """Without one final ``s`` unless it is doubled; a lone ``s`` becomes empty."""
    return F.regexp_replace(c, r"(?<!s)s\z", "")


def clean_name(c: Column) -> Column:
    """A slug: lower case, other signs than a-z and 0-9 as one underscore, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def strip_country_prefix(column: Column, country: Column, normal=tidy_text) -> Column:
    """The normal form of a column name without the country it starts with."""
    col, start = normal(column), F.concat(normal(country), F.lit(" "))
    return F.when(F.startswith(col, start), F.substr(col, F.length(start) + 1)).otherwise(col)


def zero_pad(c: Column, width: int = 2) -> Column:
    """A whole number with leading zeros; longer ones stay whole."""
    return F.format_string(f"%0{width}d", c)


def safe_int(c: Column, default: int = 1) -> Column:
    """The digits of a malformed attribute as a number; ``default`` if there are none or too many."""
    return F.coalesce(F.regexp_replace(c, "[^0-9]", "").try_cast("int"), F.lit(default))


def is_quantity(c: Column) -> Column:
    """A bare number, a text that ends in a number in brackets, or a counted status."""
    s = F.lower(F.trim(c))
    return s.rlike(r"^\d+$") | s.rlike(r"\(\d+\)$") | s.rlike(r"(active|in service|total)\s*\(\d+\)")


def clean_html(c: Column) -> Column:
    """Reference marks, superscripts, edit links and comments out; white space collapsed. Brackets of over ten signs stay."""
    c = F.regexp_replace(nfkc(c), r"\[[0-9a-zA-Z ]{1,10}\]", "")
    return _strip_markup(c)


def _strip_markup(c: Column) -> Column:
    c = F.regexp_replace(c, r"(?is)<sup\b[^>]*>.*?</sup>", "")
    c = F.regexp_replace(c, r"(?is)<span[^>]*class=\"[^\"]*mw-editsection[^\"]*\"[^>]*>.*?</span>", "")
    c = F.regexp_replace(c, r"(?s)<!--.*?-->", "")
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def escape_literal(c: Column) -> Column:
    return F.regexp_replace(F.coalesce(c, F.lit("")), "'", "''")


def escape_identifier(c: Column) -> Column:
    return F.regexp_replace(c, '"', '""')


def section_title(h2: Column, h3: Column, h4: Column) -> Column:
    """The non-empty headings joined by ``_``, else ``untitled``."""
    parts = F.filter(F.array(h2, h3, h4), lambda h: h.isNotNull() & (h != ""))
    return F.coalesce(F.nullif(F.array_join(parts, "_"), F.lit("")), F.lit("untitled"))


def table_key(country: Column, table_idx: Column, title: Column) -> Column:
    """``<country>_table_<nn>_<title>`` in slugs."""
    return F.concat(clean_name(country), F.lit("_table_"), zero_pad(table_idx), F.lit("_"), clean_name(title))


def country_of_key(key: Column) -> Column:
    """What stands before ``_table_`` in a table key; empty if it doesn't stand there."""
    at = F.instr(key, "_table_")
    return F.substr(key, F.lit(1), F.greatest(at - 1, F.lit(0)))


def run_stamp(at: Column | None = None) -> Column:
    return F.date_format(F.current_timestamp() if at is None else at, "yyMMddHHmmss")
