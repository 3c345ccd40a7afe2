"""Character folding with built-in expressions: the tables come from Unicode by rule, not by hand."""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Letters with one base letter and marks: Latin, Greek, Cyrillic and Latin Extended Additional.
_RANGES = ((0xC0, 0x24F), (0x370, 0x4FF), (0x1E00, 0x1EFF))


@cache
def _decompositions() -> dict[str, str]:
    return {chr(i): d for a, b in _RANGES for i in range(a, b + 1) if (d := unicodedata.normalize("NFD", chr(i))) != chr(i)}


def decompose(c: Column) -> Column:
    """Letters with marks as base letter and marks, so that both ways of writing them are equal."""
    pairs = F.create_map(*[F.lit(x) for kv in _decompositions().items() for x in kv])
    apart = F.array_join(F.transform(F.split(c, ""), lambda ch: F.coalesce(F.try_element_at(pairs, ch), ch)), "")
    return F.when(c.rlike(r"[^\x00-\x7f]"), apart).otherwise(c)


def strip_accents(c: Column) -> Column:
    """Base letters only."""
    one = {k: v[0] for k, v in _decompositions().items()}
    return F.regexp_replace(F.translate(c, "".join(one), "".join(one.values())), r"\p{M}", "")


def halfwidth(c: Column) -> Column:
    """Full-width forms of ASCII signs as ASCII, and the wide space as a space."""
    wide = "".join(chr(i + 0xFEE0) for i in range(0x21, 0x7F)) + "\u3000"
    return F.translate(c, wide, "".join(chr(i) for i in range(0x21, 0x7F)) + " ")


def letters_and_digits(c: Column) -> Column:
    """Lower case, only letters, their marks, and digits."""
    return F.regexp_replace(decompose(F.lower(c)), r"[^\p{L}\p{M}\p{N}]", "")
