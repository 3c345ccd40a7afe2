"""Several values packed in one cell, parted by the cheapest dialect."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator, Sequence
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtab.session import cut_lineage

#: Dialects: how a cell may be parted (Java patterns; values are trimmed afterwards). Strong delimiters mix freely within one cell.
DIALECTS: tuple[tuple[str, str], ...] = (
    ("single", r"(?!)"),
    ("strong", r";[;\s]*|[|•·‣▪¦]|(?i:<br ?/?>)|[\r\n]|\s/\s"),
    ("numbered", r"(?:^|\s)(?:\(\d{1,3}\)|\d{1,3}[.)])\s"),
    ("comma", r",(?:\s*(?:and|or|&)\s)?"),
    ("comma_and", r",(?:\s*(?:and|or|&)\s)?|\s(?:and|or|&)\s"),
    ("slash", r"/"),
    ("or", r"\sor\s"),
)
#: Finds a delimiter of any dialect, and sometimes a sign that is none; quick, as every cell of every row is looked at.
ANY_DELIMITER = r"[;,/|•·‣▪¦&<\r\n]|\s(?:and|or|\(?\d{1,3}[.)])\s|^\(?\d{1,3}[.)]\s"

_MONTHS = "Jan(?:uary)?|Feb(?:ruary)?|Mar(?:ch)?|Apr(?:il)?|May|June?|July?|Aug(?:ust)?|Sept?(?:ember)?|Oct(?:ober)?|Nov(?:ember)?|Dec(?:ember)?"
#: Quotes as part of a dialect: ``quoted`` text is never parted, or the straight mark is a ``letter`` (as for inches). A quote opens and closes at the edge of a word.
QUOTES: tuple[tuple[str, str], ...] = (("quoted", r'(?<![\p{L}\p{N}])"[^"]*"(?![\p{L}\p{N}])'), ("letter", ""))
#: Text that no dialect parts: quotes whose two marks differ, brackets, dates with a comma or slashes, spans of years.
PROTECTED: tuple[str, ...] = (
    r"“[^”]*”",
    r"«[^»]*»",
    r"„[^“”]*[“”]",
    r"\([^()]*[^()\d][^()]*\)",
    r"\[[^\[\]]*\]",
    rf"(?<!\p{{L}})(?:{_MONTHS})\.? \d{{1,2}}, ?\d{{4}}(?!\d)",
    r"(?<!\d)\d{1,2}/\d{1,2}/\d{2,4}(?!\d)",
    r"(?<!\d)\d{4}(?:/|\s?[–—-]\s?)(?:\d{4}|\d{2})(?![\d/-])",
)
_OPEN, _CLOSE, _CUT, _QUOTE = "\u0001", "\u0002", "\u0003", "\u0004"


def guard_names(names: Sequence[str]) -> str:
    """A pattern for names that hold a delimiter themselves, the longest first; common beginnings are written once, so many names cost little."""

    def quote(text: str) -> str:
        return re.sub(r"([^\w\s])", r"\\\1", text)

    def tree(words: list[str]) -> str:
        ways: list[str] = []
        for _, group in groupby((w for w in words if w), key=lambda w: w[0]):
            group = list(group)
            head = os.path.commonprefix(group)
            rest = tree([w[len(head) :] for w in group]) if len(group) > 1 else ""
            ways.append(quote(head) + rest)
        inner = "|".join(ways)
        return (f"(?:{inner})?" if "" in words else f"(?:{inner})") if inner else ""

    ordered = sorted({n for n in names if n})
    return rf"(?<!\p{{L}}){tree(ordered)}(?!\p{{L}})" if ordered else ""


def _plain(cell: Column) -> Column:
    """A cell without the signs that mark its parts, and with doubled quotes as one sign."""
    text = F.translate(cell, _OPEN + _CLOSE + _CUT + _QUOTE, "")
    text = F.regexp_replace(text, '(^|[;,|•/>\\s])"""(?!")', f'$1"{_QUOTE}')
    return F.regexp_replace(text, '""', _QUOTE)


def protect(cell: Column, names: str = "", quotes: str = QUOTES[0][1]) -> Column:
    """A cell with what is never parted between two marks; done once for each style of quotes, so that each dialect only looks at the marks."""
    kept = "|".join(x for x in (names, quotes, *PROTECTED) if x)
    return F.regexp_replace(_plain(cell), f"({kept})", f"{_OPEN}$1{_CLOSE}")


def part(protected: Column, delimiter: str) -> Column:
    """The non-empty values of a protected cell under one delimiter pattern."""
    # a delimiter becomes a cut; marked text comes out whole with a cut behind it, which goes again
    marked = F.regexp_replace(protected, f"({_OPEN}[^{_CLOSE}]*+{_CLOSE})|(?:{delimiter})", f"$1{_CUT}")
    values = F.split(F.regexp_replace(marked, f"{_CLOSE}{_CUT}", _CLOSE), _CUT)
    return F.filter(F.transform(values, lambda v: clean_value(F.translate(v, _OPEN + _CLOSE, ""))), lambda v: v != "")


def clean_value(v: Column) -> Column:
    """Without outer white space, list number, enclosing quotes and doubled inner quotes."""
    v = F.regexp_replace(v, r"^[\s\p{Z}\p{Cf}]+|(?<![\s\p{Z}\p{Cf}])[\s\p{Z}\p{Cf}]++$", "")
    v = F.regexp_replace(v, r"^(?:\(\d{1,3}\)|\d{1,3}[.)])\s+", "")
    v = F.regexp_replace(v, rf"^{_QUOTE}$", "")
    v = F.regexp_replace(v, r'(?s)^(?:"([^"]*)"|“([^”]*)”|«([^»]*)»|„([^“”]*)[“”])$', "$1$2$3$4")
    return F.regexp_replace(F.regexp_replace(v, _QUOTE, '"'), r"^\s+|(?<!\s)\s++$", "")


def value_shape(v: Column) -> Column:
    """The writing pattern of a value: runs of capitals, small letters and digits as one sign each; a long pattern by its SHA-256."""
    s = F.regexp_replace(v, r"\p{Lu}?\p{Ll}+", "a")
    s = F.regexp_replace(s, r"\p{Lu}+", "A")
    s = F.regexp_replace(s, r"\d+", "9")
    s = F.regexp_replace(s, r"a (?=a(?!\p{L}))", "")
    return F.when(F.length(s) <= 60, s).otherwise(F.concat(F.lit(_OPEN), F.sha2(s, 256)))


#: What a sign costs, and a straight quote that opens nothing and follows no number, in bits (fixed values).
SIGN_BITS, STRAY_BITS = 4.0, 16.0


def _ways(cell: Column, protected: Sequence[Column]) -> Column:
    """Every dialect's parse of a cell that is protected for each style of quotes: (rank, dialect, items), without dialects that can't differ from an earlier one."""
    ways = []
    for style, ((label, _), marked) in enumerate(zip(QUOTES, protected)):
        for i, (d, rx) in enumerate(DIALECTS):
            rank, name = style * len(DIALECTS) + i, d if style == 0 else f"{d}, quotes as {label}s"
            one = F.struct(F.lit(rank).alias("rank"), F.lit(name).alias("dialect"), part(marked, rx).alias("items"))
            if i == 0 and style == 0:
                ways.append(one)
            elif i:  # one value is one value in either style
                ways.append(F.when(marked.isNotNull() & cell.rlike(rx), one))
    return F.filter(F.array(*ways), lambda w: w.isNotNull())


def split_packed(rows: DataFrame, fields: Sequence[str], guards: Sequence[str] = (), id_: str = "row_id") -> DataFrame:
    """``row_id, field_name, item_pos, item_value, n_items, dialect`` of each value of each cell.

    A dialect is a kind of delimiter and a style of quotes. Cells without any
    delimiter are one value and are read in place. Every other distinct cell is
    parted by every dialect. A parse costs, for each of its values, the length
    of the value's code: the value's own share among all values if it stands
    alone elsewhere, else the share of its writing pattern plus a fixed price
    per sign, and more for a straight quote without a partner that follows no
    number. Shares are counted over the whole column: from cells that all
    dialects part alike, and from the parts at strong delimiters, which stand
    inside a value only by mistake. The cheapest parse holds; of equal ones the
    one with fewer values, then the first by style of quotes and by
    :data:`DIALECTS`.

    Positions count from 1 over non-empty values, and a repeated value counts
    again. NULL cells and cells without a value give no row; a cell of signs
    alone is one value. A cell in which a quote never closes is parted as if
    the quote were a letter. ``guards`` are names that hold a delimiter and are
    one value. Very long cells are parted whole. Repeated ``row_id`` repeat
    their values; other columns don't matter.
    """
    names = guard_names(guards)
    long = rows.select(id_, F.inline(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).alias("cell")) for f in fields])))
    long, open_ = long.where("cell IS NOT NULL"), F.col("cell").rlike(ANY_DELIMITER)
    single = clean_value(_plain(F.col("cell")))
    cells = long.groupBy("field_name", "cell").agg(F.count(F.lit(1)).alias("n")).withColumn("open", open_)
    marked = {f"as_{label}": F.when(F.col("open") & (F.col("cell").contains('"') | F.lit(i == 0)), protect(F.col("cell"), names, rx)) for i, (label, rx) in enumerate(QUOTES)}
    one = F.array(F.struct(F.lit(0).alias("rank"), F.lit(DIALECTS[0][0]).alias("dialect"), F.filter(F.array(single), lambda v: v != "").alias("items")))
    parses = cells.withColumns(marked).select("field_name", "cell", "n", "open", F.when(F.col("open"), _ways(F.col("cell"), [F.col(m) for m in marked])).otherwise(one).alias("all"))
    # dialects that part alike are one, known by the first of them
    distinct = F.filter("all", lambda p, i: F.size(F.filter(F.slice(F.col("all"), 1, i), lambda q: q["items"] == p["items"])) == 0)
    # each distinct cell is parsed once and has a number from then on: kept in the shared folder, or the filter below would move before the grouping
    parses = cut_lineage(parses.select("field_name", _cell_key(F.col("cell")).alias("cell"), "n", "open", F.monotonically_increasing_id().alias("cid"), distinct.alias("ways"))).where(F.size(F.element_at("ways", 1)["items"]) > 0)
    # value codes: learned where the parse is not in question, or from the strong dialect where it parts
    # quotes that quote are the rule, so a parse that only another style of quotes puts in question teaches
    sure = F.when(F.size(F.filter("ways", lambda w: w["rank"] < len(DIALECTS))) == 1, F.element_at("ways", 1)["items"]).otherwise(
        F.flatten(F.transform(F.filter("ways", lambda w: w["dialect"] == "strong"), lambda w: w["items"]))
    )
    taught = parses.select("field_name", "n", F.explode(sure).alias("value"))
    values = taught.groupBy("field_name", "value").agg(F.sum("n").alias("n"))
    shapes = values.groupBy("field_name", value_shape(F.col("value")).alias("shape")).agg(F.sum("n").alias("n"))
    totals = values.groupBy("field_name").agg(F.sum("n").alias("total"))
    doubtful = parses.where(F.size("ways") > 1).select("field_name", "cid", F.explode("ways").alias("way"))
    pieces = doubtful.select("field_name", "cid", F.col("way.rank").alias("rank"), F.explode("way.items").alias("value"))
    wanted = pieces.groupBy("field_name", "value").agg(F.count(F.lit(1)).alias("uses")).withColumn("shape", value_shape(F.col("value")))
    coded = (
        wanted.join(values.withColumnRenamed("n", "n_value"), ["field_name", "value"], "left")
        .join(shapes.withColumnRenamed("n", "n_shape"), ["field_name", "shape"], "left")
        .join(totals, "field_name", "left")
    )
    total = F.coalesce(F.col("total"), F.lit(1)) + F.lit(1.0)
    by_value = F.when(F.col("n_value").isNotNull(), 1 - F.log2(F.col("n_value") / total))
    stray = F.regexp_count("value", F.lit(r'(?<!\d)"')) % 2 == 1
    by_shape = 1 - F.log2((F.coalesce(F.col("n_shape"), F.lit(0)) + 0.001) / total) + F.length("value") * F.lit(SIGN_BITS) + F.when(stray, STRAY_BITS).otherwise(0.0)
    costs = coded.select("field_name", "value", F.least(by_value, by_shape).alias("bits"))
    priced = pieces.join(costs, ["field_name", "value"]).groupBy("cid", "rank").agg(F.sum("bits").alias("bits"), F.count(F.lit(1)).alias("k"))
    best = priced.groupBy("cid").agg(F.min(F.struct(F.round("bits", 6).alias("bits"), "k", "rank")).alias("b"))
    best = best.select("cid", F.col("b.rank").alias("best"))
    # rows of cells without a delimiter need no parse, so they are never shuffled
    chosen = parses.where("open").join(best, "cid", "left").select(
        "field_name", "cell", F.coalesce(F.get(F.filter("ways", lambda w: w["rank"] == F.col("best")), F.lit(0)), F.element_at("ways", 1)).alias("way")
    )
    keyed = long.where(open_).select(id_, "field_name", _cell_key(F.col("cell")).alias("cell")).join(chosen, ["field_name", "cell"])
    counted = keyed.select(id_, "field_name", F.size("way.items").alias("n_items"), F.col("way.dialect").alias("dialect"), F.col("way.items").alias("items"))
    placed = counted.select(id_, "field_name", "n_items", "dialect", F.posexplode("items").alias("p", "item_value"))
    several = placed.select(id_, "field_name", (F.col("p") + 1).alias("item_pos"), "item_value", "n_items", "dialect")
    whole = long.where(~open_).select(id_, "field_name", F.lit(1).alias("item_pos"), single.alias("item_value"), F.lit(1).alias("n_items"), F.lit(DIALECTS[0][0]).alias("dialect"))
    return several.unionByName(whole.where("item_value <> ''"))


def _cell_key(cell: Column) -> Column:
    """A short cell itself, a long one by its SHA-256, so that its values don't each carry the whole cell."""
    return F.when(F.length(cell) <= 64, cell).otherwise(F.concat(F.lit(_OPEN), F.sha2(cell, 256)))


def names_with_delimiters(names: DataFrame, column: str = "country", bound: int = 100_000) -> list[str]:
    """The distinct names that hold a delimiter themselves; refuses more than ``bound``, as they become one pattern (a tree of their common beginnings) that is sent to all tasks."""
    rx = "|".join(rx for _, rx in DIALECTS[1:])
    found = names.select(F.trim(F.col(column)).alias("name")).where(F.col("name").rlike(f"({rx})")).distinct().limit(bound + 1).collect()
    if len(found) > bound:
        raise ValueError(f"more than {bound} distinct values of {column} hold a delimiter; they are no names")
    return sorted(r["name"] for r in found)
