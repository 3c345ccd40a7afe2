"""Column, row and table cleaning over the long form: one DataFrame for all tables.

A row is ``table_name, row_idx, cells`` with cells of position, name and value.
Dynamic schemas live inside the cells, so nothing here depends on the columns
of any one table, and every step is one pass with at most one shuffle by
``table_name``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomtab.functions.text import is_quantity, nfkc_each, strip_country_prefix, tidy_text

#: Columns of pictures; a name that contains one is dropped (fixed values). Note that ``file`` also hits ``profile``.
IMAGE_WORDS = ("image", "photo", "thumbnail", "file", "picture", "illustration", "portrait", "insignia")

#: Rows of a table that are filled forward together; blocks of a very long table are filled apart and hand on their last announcement.
BLOCK = 100_000

Normal = Callable[[Column], Column]


def _cell(pos: Column, name: Column, value: Column) -> Column:
    return F.struct(pos.cast("int").alias("pos"), name.alias("name"), value.alias("value"))


def from_scrapes(raw_rows: DataFrame, key: str = "meta_id") -> DataFrame:
    """Rows keyed by scrape, so that several scrapes of one table don't mix; ``table_name`` becomes the scrape's key."""
    return raw_rows.select(F.col(key).cast("string").alias("table_name"), "row_idx", "cells")


def compose_names(rows: DataFrame) -> DataFrame:
    """Column names in NFKC, for rows that didn't come through the page reader, which composes whole pages."""
    composed = rows.withColumn("__names", nfkc_each(F.transform("cells", lambda c: c["name"])))
    cells = F.transform("cells", lambda c, i: _cell(c["pos"], F.get("__names", i), c["value"]))
    return composed.withColumn("cells", cells).drop("__names")


def headers(rows: DataFrame) -> DataFrame:
    """``table_name, names``: the column names of each table in order of position.

    Names are merged from all rows, as a row may lack cells.
    """
    # rows of a table mostly have one list of names, so lists are told apart before they are taken apart
    heads = rows.select("table_name", F.transform("cells", lambda c: F.struct(c["pos"].alias("pos"), c["name"].alias("name"))).alias("h")).groupBy("table_name", "h").agg(F.lit(1).alias("one"))
    names = heads.select("table_name", F.inline("h")).groupBy("table_name", "pos").agg(F.min("name").alias("name"))
    return names.groupBy("table_name").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "name"))), lambda c: c["name"]).alias("names"))


def _suffixless(name: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(F.coalesce(name, F.lit("")), r"\.\d+$", "")))


def split_doublewide(rows: DataFrame, positional: bool = True) -> DataFrame:
    """Tables whose right half repeats the left half's names become one table of twice the rows.

    Such a table has an even number of columns, equal in pairs after a ``.N``
    suffix is cut off. Left rows come first, and rows without any value are
    left out of both halves. With ``positional`` the halves are laid one under
    the other; without it the right half keeps its suffixed names, which gives
    a staggered union.
    """
    half = (F.size("names") / 2).cast("int")
    left, right = F.slice("names", F.lit(1), half), F.slice("names", half + 1, half)
    same = F.forall(F.arrays_zip(left.alias("a"), right.alias("b")), lambda p: _suffixless(p["a"]) == _suffixless(p["b"]))
    wide = headers(rows).where((F.size("names") > 0) & (F.size("names") % 2 == 0)).where(same).select("table_name", half.alias("half"), "names")
    # right rows are numbered after the last left one; numbers may have gaps
    wide = wide.join(rows.groupBy("table_name").agg((F.max("row_idx") + 1).alias("n")), "table_name")
    joined = rows.join(wide, "table_name", "left")
    double = F.col("half").isNotNull()
    sides = F.when(double, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    sided = joined.select("table_name", "row_idx", "cells", "half", "names", "n", F.explode(sides).alias("side"))
    in_side = F.filter("cells", lambda c: F.when(F.col("side") == 0, c["pos"] < F.col("half")).otherwise(c["pos"] >= F.col("half")))
    moved = F.transform(in_side, lambda c: _cell(c["pos"] - F.col("side") * F.col("half"), F.get("names", c["pos"] - F.col("side") * F.col("half")), c["value"]))
    same_cells = F.transform("cells", lambda c: _cell(c["pos"], c["name"], c["value"]))
    split = moved if positional else F.transform(in_side, lambda c: _cell(c["pos"], c["name"], c["value"]))
    both = sided.select("table_name", "row_idx", F.when(double, split).otherwise(same_cells).alias("cells"), "side", "n", double.alias("double")).where(
        ~F.col("double") | F.exists("cells", lambda c: c["value"].isNotNull())
    )
    return both.select("table_name", (F.col("row_idx") + F.col("side") * F.coalesce("n", F.lit(0))).alias("row_idx"), "cells")


def make_unique(names: Column) -> Column:
    """Names with ``_2``, ``_3`` … on the second and later occurrence."""

    def numbered(x: Column, i: Column) -> Column:
        before = F.size(F.filter(F.slice(names, F.lit(1), i), lambda y: y.eqNullSafe(x)))
        return F.when(before > 0, F.concat(x, F.lit("_"), (before + 1).cast("string"))).otherwise(x)

    return F.transform(names, numbered)


def header_parts(name: Column) -> Column:
    """The parts of a header written as a tuple, ``('a', 'b')``; other headers are one part."""
    inner = F.regexp_extract_all(name, F.lit(r"""'((?:[^'\\]|\\.)*)'|"((?:[^"\\]|\\.)*)"|([^\s,()'"][^,()'"]*)"""), F.lit(0))
    clean = F.transform(inner, lambda p: F.regexp_replace(F.trim(p), r"""^['"]|['"]$""", ""))
    return F.when(name.rlike(r"^\(.*,.*\)$"), clean).otherwise(F.array(name))


def multi_level_names(names: Column, normal: Normal = tidy_text) -> tuple[Column, Column]:
    """(column names, what is left over) of tuple headers.

    The first level whose values all differ gives the names, else the first.
    The other parts of a column, joined by ``, ``, are left over for a row of
    their own.
    """
    parts = F.transform(names, lambda n: F.transform(header_parts(n), normal))
    depth = F.array_min(F.transform(parts, lambda p: F.size(p)))
    levels = F.transform(F.sequence(F.lit(0), F.greatest(depth - 1, F.lit(0))), lambda i: F.transform(parts, lambda p: F.get(p, i)))
    distinct = F.filter(levels, lambda level: F.size(F.array_distinct(level)) == F.size(level))
    chosen = F.coalesce(F.get(distinct, F.lit(0)), F.get(levels, F.lit(0)))
    left = F.transform(parts, lambda p: F.nullif(F.array_join(F.filter(p, lambda x: ~F.array_contains(chosen, x)), ", "), F.lit("")))
    return chosen, left


def standardize_names(rows: DataFrame, normal: Normal = tidy_text) -> DataFrame:
    """Normal column names; tuple headers are taken apart and what is left over becomes a first row (``row_idx`` -1)."""
    tuple_head = r"^\(.*,.*\)$"
    named = headers(rows).withColumn("multi", F.exists("names", lambda n: n.rlike(tuple_head)))
    chosen, left = multi_level_names(F.col("names"), normal)
    plan = named.select(
        "table_name",
        "multi",
        F.when(F.col("multi"), make_unique(chosen)).otherwise(F.transform("names", normal)).alias("new_names"),
        F.when(F.col("multi"), left).alias("left_over"),
    )
    first = rows.groupBy("table_name").agg(F.min("row_idx").alias("first"))
    joined = rows.join(plan.join(first, "table_name"), "table_name")
    unreal = lambda c: F.coalesce(F.trim(c["name"]).rlike(r"^(\d+$|unnamed)"), F.lit(True))
    renamed = F.transform("cells", lambda c: _cell(c["pos"], F.get("new_names", c["pos"]), c["value"]))
    # digits and unnamed columns go only from tables with tuple headers
    real = F.filter(renamed, lambda c: ~F.col("multi") | ~unreal(c))
    extra = F.filter(F.transform("new_names", lambda n, i: _cell(i, n, F.get("left_over", i))), lambda c: ~unreal(c))
    own = F.struct(F.col("row_idx").alias("row_idx"), real.alias("cells"))
    lines = F.when(F.col("multi") & (F.col("row_idx") == F.col("first")), F.array(F.struct(F.lit(-1).alias("row_idx"), extra.alias("cells")), own))
    out = joined.select("table_name", F.inline(lines.otherwise(F.array(own))))
    return out.select("table_name", "row_idx", F.transform("cells", lambda c: _cell(c["pos"], normal(c["name"]), c["value"])).alias("cells"))


def drop_superfluous(rows: DataFrame, normal: Normal = tidy_text) -> DataFrame:
    """Without columns of pictures, unnamed ones, and those named by a number."""
    rx = rf"({'|'.join(IMAGE_WORDS)})|^unnamed|^\d+$"
    return rows.withColumn("cells", F.filter("cells", lambda c: ~F.coalesce(normal(c["name"]).rlike(rx), F.lit(False))))


def row_kind(cells: Column) -> Column:
    """``empty`` if all values are blank; ``quantity`` or ``section`` if all are equal; else ``data``. A row without cells is empty."""
    values = F.array_distinct(F.transform(cells, lambda c: F.trim(F.coalesce(c["value"], F.lit("")))))
    only = F.get(values, F.lit(0))
    return (
        F.when(F.coalesce(F.size(values), F.lit(0)) <= 0, "empty")
        .when(F.size(values) > 1, "data")
        .when(only == "", "empty")
        .when(is_quantity(only), "quantity")
        .otherwise("section")
    )


def propagate_sections(rows: DataFrame) -> DataFrame:
    """``table_name, row_idx, section, quantity, cells`` of data rows, with what the rows above them announce.

    A section row announces its text without ``(n)`` and, as quantity, its
    first ``(n)`` with the brackets or none; each announcement replaces the one
    before as a whole, also by NULL. ``has_section`` and ``has_quantity`` say
    whether the table has such rows at all; only then do the new columns stand
    first and replace raw ones of the same name. Rows are numbered anew.
    """
    text = F.trim(F.coalesce(F.get("cells", F.lit(0))["value"], F.lit("")))
    number = F.nullif(F.regexp_extract(text, r"\(\d+\)", 0), F.lit(""))
    meta = F.col("kind").isin("section", "quantity")
    told = F.when(meta, F.struct(F.trim(F.regexp_replace(text, r"\(\d+\)", "")).alias("section"), number.alias("quantity")))
    kinds = rows.select("table_name", "row_idx", "cells", row_kind(F.col("cells")).alias("kind"), F.floor(F.col("row_idx") / BLOCK).alias("block"))
    kinds = kinds.withColumn("told", told)
    # what each block of rows hands on, and how many data rows it has
    blocks = kinds.groupBy("table_name", "block").agg(
        F.max_by("told", F.when(F.col("told").isNotNull(), F.col("row_idx"))).alias("last_told"),
        F.count_if(F.col("kind") == "data").alias("n_data"),
        F.max(meta).alias("has_section"),
        F.max(F.col("kind") == "quantity").alias("has_quantity"),
    )
    before = W.partitionBy("table_name").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy("table_name")
    carried = blocks.select(
        "table_name", "block",
        F.last("last_told", ignorenulls=True).over(before).alias("carry"),
        F.coalesce(F.sum("n_data").over(before), F.lit(0)).alias("rows_before"),
        F.max("has_section").over(whole).alias("has_section"),
        F.max("has_quantity").over(whole).alias("has_quantity"),
    )
    within = W.partitionBy("table_name", "block").orderBy("row_idx")
    filled = kinds.withColumn("told", F.last("told", ignorenulls=True).over(within.rowsBetween(W.unboundedPreceding, 0))).where("kind = 'data'")
    numbered = filled.withColumn("k", F.row_number().over(within) - 1).join(carried, ["table_name", "block"])
    known = F.coalesce("told", "carry")
    return numbered.select(
        "table_name",
        (F.col("rows_before") + F.col("k")).cast("int").alias("row_idx"),
        F.when(F.col("has_section"), known["section"]).alias("section"),
        F.when(F.col("has_quantity"), known["quantity"]).alias("quantity"),
        "has_section",
        "has_quantity",
        "cells",
    )


def with_section_cells(rows: DataFrame) -> DataFrame:
    """The announced columns as first cells, in place of raw ones of those names."""
    front = F.filter(
        F.array(
            F.when(F.col("has_section"), _cell(F.lit(-2), F.lit("section"), F.col("section"))),
            F.when(F.col("has_quantity"), _cell(F.lit(-1), F.lit("quantity"), F.col("quantity"))),
        ),
        lambda c: c.isNotNull(),
    )
    rest = F.filter(
        "cells",
        lambda c: ~F.coalesce((F.col("has_section") & (c["name"] == "section")) | (F.col("has_quantity") & (c["name"] == "quantity")), F.lit(False)),
    )
    placed = F.transform(F.concat(front, rest), lambda c, i: _cell(i, c["name"], c["value"]))
    return rows.select("table_name", "row_idx", placed.alias("cells"))


def drop_meaningless(rows: DataFrame) -> DataFrame:
    """Without tables that have no columns or only numbered, unnamed or ``col_`` ones; one flag per table, no cell is shuffled."""
    meant = F.exists("cells", lambda c: ~F.coalesce(F.lower(F.trim(c["name"])).rlike(r"^(\d+$|unnamed|col_)"), F.lit(True)))
    named = rows.groupBy("table_name").agg(F.max(meant).alias("meant")).where("meant").select("table_name")
    return rows.join(named, "table_name", "left_semi")


def strip_country(rows: DataFrame, tables: DataFrame, normal: Normal = tidy_text) -> DataFrame:
    """Column names without the country of their table (``table_name, country``) where they start with it.

    A name that would then be empty or equal another one of its row stays.
    """
    joined = rows.join(tables.groupBy("table_name").agg(F.min("country").alias("__country")), "table_name", "left")
    names = F.array_compact(F.transform("cells", lambda c: c["name"]))

    def bare(c: Column) -> Column:
        short = strip_country_prefix(c["name"], F.col("__country"), normal)
        free = F.coalesce((short != "") & ~F.array_contains(names, short), F.lit(False))
        return _cell(c["pos"], F.when(free, short).otherwise(c["name"]), c["value"])

    return joined.select("table_name", "row_idx", F.transform("cells", bare).alias("cells"))


def clean_all(rows: DataFrame, normal: Normal = tidy_text, positional: bool = True) -> DataFrame:
    """Columns, then rows, then tables. Tables without data rows or columns are gone."""
    columns = drop_superfluous(standardize_names(split_doublewide(rows, positional), normal), normal)
    return drop_meaningless(with_section_cells(propagate_sections(columns)))


def column_list(rows: DataFrame) -> DataFrame:
    """``table_name, column_name, pos`` of each non-blank column, in long form."""
    listed = headers(rows).select("table_name", F.posexplode("names").alias("pos", "column_name"))
    return listed.where("column_name IS NOT NULL AND lower(column_name) NOT IN ('', 'null')").select("table_name", "column_name", "pos")


def wide_columns(columns: DataFrame, names: list[str]) -> DataFrame:
    """One line per table and one column per listed name that holds its own name; the sparse wide view."""
    return columns.groupBy("table_name").pivot("column_name", names).agg(F.first("column_name"))


def global_first_seen(columns: DataFrame, seq: str = "table_seq") -> DataFrame:
    """``table_name, names``: each table's columns in the order in which names were first seen over all tables."""
    first = columns.groupBy("column_name").agg(F.min(F.struct(seq, "pos")).alias("rank"))
    joined = columns.join(first, "column_name")
    return joined.groupBy("table_name").agg(F.transform(F.array_sort(F.collect_set(F.struct("rank", "column_name"))), lambda c: c["column_name"]).alias("names"))
