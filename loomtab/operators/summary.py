"""Null-safe aggregates of the canonical table, and the views built on them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Bins of classes in the crosstab (fixed values); other classes are their own bin.
CLASS_BINS = {
    "Aircraft & Satellite": ("Aircraft", "Satellite"),
    "Artillery, Tank, Vehicle": ("Artillery", "Tank", "Vehicle"),
    "Boat, Corvette, Cruiser, Destroyer, Frigate, Submarine, Vessel": ("Boat", "Corvette", "Cruiser", "Destroyer", "Frigate", "Submarine", "Vessel"),
}
SUMMARY_KEYS = ("country", "class_path", "sub_class")


def summarise(rows: DataFrame, keys: Sequence[str] = SUMMARY_KEYS, quantity: str = "quantity_clean", hidden: str | None = "Equipment") -> DataFrame:
    """``<keys>, total_quantity``: sums by key of rows with a quantity and a path.

    Rows of the root class are left out null-safely: a NULL class is not the
    root and stays. Map-side partial sums precede the one shuffle.
    """
    kept = rows.where(F.col(quantity).isNotNull() & F.col("class_path").isNotNull())
    if hidden is not None:
        kept = kept.where(~F.col("sub_class").eqNullSafe(F.lit(hidden)))
    return kept.groupBy(*keys).agg(F.sum(quantity).alias("total_quantity"))


def class_bin(c: Column, bins: Mapping[str, Sequence[str]] = CLASS_BINS) -> Column:
    case = F
    for name, members in bins.items():
        case = case.when(c.isin(*members), F.lit(name))
    return case.otherwise(c)


def manual_order(c: Column, order: Sequence[str | None]) -> Column:
    """Rank of a value in a listed order; unlisted values come last."""
    case = F
    for i, v in enumerate(order):
        case = case.when(c.eqNullSafe(F.lit(v)), F.lit(i))
    return case.otherwise(F.lit(len(order)))


def include_members(rows: DataFrame, column: str, members: Sequence[str | None]) -> DataFrame:
    """Rows whose value is listed; None lists NULL."""
    named = [m for m in members if m is not None]
    keep = F.coalesce(F.col(column).isin(*named), F.lit(False)) if named else F.lit(False)
    return rows.where(keep | F.col(column).isNull() if None in members else keep)


def exclude_pairs(rows: DataFrame, pairs: Sequence[tuple[str, str]], columns: tuple[str, str]) -> DataFrame:
    """Rows without those whose two values are a listed pair; NULLs are in no pair."""
    listed = rows.sparkSession.createDataFrame(list(pairs), ", ".join(f"{c} string" for c in columns))
    return rows.join(F.broadcast(listed), list(columns), "left_anti")  # a literal list, not data


def crosstab(rows: DataFrame, row: str, column: str, value: str, columns: Sequence[str]) -> DataFrame:
    """One line per ``row`` and one column per listed value; the list is given, so no extra job looks for it."""
    return rows.groupBy(row).pivot(column, list(columns)).agg(F.sum(value))


def top_rows(rows: DataFrame, by: str, tie: str, k: int) -> DataFrame:
    """The ``k`` rows with the largest ``by``, numbered by ``place`` from 1; NULLs come last, equal ones by ``tie``.

    Partitions hand over at most ``k`` rows each, and only the ``k`` best are numbered.
    """
    order = (F.desc_nulls_last(by), F.asc_nulls_first(tie))
    return rows.orderBy(*order).limit(k).withColumn("place", F.row_number().over(W.orderBy(*order)))
