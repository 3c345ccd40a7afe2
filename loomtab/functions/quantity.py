"""Messy quantities as whole numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Numbers in this range are years unless nothing else is left (fixed values).
YEARS = (1950, 2050)
#: Prefixes of ship names (fixed values).
SHIP_PREFIXES = ("USS", "HMS", "HS", "INS", "ČMP", "KRI", "HMAS")


def has_several_names(name: Column) -> Column:
    """A cell that seems to list several ships: a separator, a repeated prefix or bracket, or over two capitalised words."""
    flags = [F.contains(name, F.lit(s)) for s in (",", ";")]
    flags += [F.regexp_count(name, F.lit(p)) > 1 for p in SHIP_PREFIXES]
    flags += [F.regexp_count(name, F.lit(r"\(")) > 1, F.regexp_count(name, F.lit(r"\b[A-Z][a-zA-Z]+\b")) > 2]
    any_of = flags[0]
    for flag in flags[1:]:
        any_of = any_of | flag
    return F.coalesce(any_of, F.lit(False))


def clean_quantity(raw: Column, ship_name: Column | None = None) -> Column:
    """The number a quantity states, or NULL.

    Several ships count one. Else all runs of digits are read, years left out
    unless they are all there is. A single ship with several numbers takes the
    one in brackets, else one; otherwise the least number holds. Runs that
    don't fit a BIGINT are no numbers.
    """
    ship = F.lit(None).cast("string") if ship_name is None else F.nullif(ship_name, F.lit(""))
    runs = F.transform(F.regexp_extract_all(raw, F.lit(r"(\d+)"), F.lit(1)), lambda n: n.try_cast("bigint"))
    found = F.filter(runs, lambda n: n.isNotNull())
    kept = F.filter(found, lambda n: ~n.between(*YEARS))
    numbers = F.when(F.size(kept) > 0, kept).otherwise(found)
    bracket = F.regexp_extract(raw, r"\((\d+)\)", 1).try_cast("bigint")
    return (
        F.when(F.trim(raw).isNull() | (F.trim(raw) == ""), F.lit(None).cast("bigint"))
        .when(has_several_names(ship), F.lit(1).cast("bigint"))
        .when(ship.isNotNull() & (F.size(numbers) > 1), F.coalesce(bracket, F.lit(1).cast("bigint")))
        .otherwise(F.array_min(numbers))
    )


def with_clean_quantity(rows: DataFrame, quantity: str = "quantity", ship: str = "ship_name") -> DataFrame:
    return rows.withColumn("quantity_clean", clean_quantity(F.col(quantity), F.col(ship)))
