"""Tables and links out of HTML pages, with the standard library's parser.

Pages stream through Arrow batches; each comes out as rows of the long form.
Attributes that decide whether a table is wanted are columns, so the decision
itself is an expression of the engine.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomtab.functions.text import clean_html, section_title, table_key

#: What makes a table junk (fixed values).
TITLE_WORDS = (
    "external links", "references", "reference", "contents", "see also",
    "bibliography", "sources", "further reading", "notes", "silhouettes",
)
PARENT_CLASSES = ("reflist", "references", "reference", "refbegin", "refend")
TABLE_CLASSES = ("toc", "metadata")
FIRST_TEXTS = (
    "external links", "references", "reference", "bibliography", "sources", "further reading",
    "notes", "see also", "contents", "contents table", "navigation menu", "related articles",
)

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: An opening tag ends these open ones, up to the nearest of the listed bounds.
_ENDS = {
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "p": ({"p"}, {"td", "th", "li", "div", "table", "section"}),
    "tbody": ({"tr", "td", "th", "thead", "tbody"}, {"table"}),
    "thead": ({"tr", "td", "th"}, {"table"}),
    "tfoot": ({"tr", "td", "th", "tbody"}, {"table"}),
    "dd": ({"dd", "dt"}, {"dl"}),
    "dt": ({"dd", "dt"}, {"dl"}),
    "option": ({"option"}, {"select"}),
}
#: Spans over columns beyond this are cut, as in the HTML standard; those over rows only end with the table.
MAX_SPAN = 1000


@dataclass
class Node:
    tag: str
    attrs: dict[str, str] = field(default_factory=dict)
    parent: Node | None = None
    children: list[Node | str] = field(default_factory=list)

    def walk(self) -> Iterator[Node]:
        """This element and all within it in document order, without recursion."""
        stack: list[Node] = [self]
        while stack:
            node = stack.pop()
            yield node
            stack.extend(c for c in reversed(node.children) if isinstance(c, Node))

    def find_all(self, *tags: str) -> Iterator[Node]:
        return (n for n in self.walk() if n is not self and n.tag in tags)

    def text(self) -> str:
        """All text pieces, each stripped, run together."""
        out, stack = [], [self]
        while stack:
            node = stack.pop()
            if isinstance(node, str):
                out.append(node.strip())
            else:
                stack.extend(reversed(node.children))
        return "".join(out)

    def spaced_text(self) -> str:
        out, stack = [], [self]
        while stack:
            node = stack.pop()
            if isinstance(node, str):
                out.append(node)
            elif node.tag == "br":
                out.append("\n")
            elif not (node is not self and node.tag == "table"):
                stack.extend(reversed(node.children))
        return " ".join("".join(out).split())

    def ancestors(self) -> Iterator[Node]:
        node = self.parent
        while node is not None:
            yield node
            node = node.parent

    @property
    def classes(self) -> list[str]:
        return self.attrs.get("class", "").split()


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("")

    def handle_starttag(self, tag: str, attrs: list) -> None:
        ends, bounds = _ENDS.get(tag, ((), ()))
        if ends:
            node, last = self.at, None
            while node.parent is not None and node.tag not in bounds:
                if node.tag in ends:
                    last = node
                node = node.parent
            if last is not None:
                self.at = last.parent
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in _VOID:
            self.at = node

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        node = self.at
        while node.parent is not None and node.tag != tag:
            if node.tag == "table" and tag != "table":
                return
            node = node.parent
        if node.parent is not None:
            self.at = node.parent

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)


def parse(html: str | None) -> Node:
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.root


def span(value: str | None, most: int = MAX_SPAN) -> int:
    """The digits of a span attribute, at most ``most``; 1 if there are none."""
    digits = "".join(c for c in value or "" if c.isdigit())
    return min(int(digits.lstrip("0")[:9] or 0), most) if digits else 1


def own_rows(table: Node) -> list[list[Node]]:
    """The cells of each row of a table, without those of tables inside it."""
    rows = []
    for tr in table.find_all("tr"):
        owner = next(a for a in tr.ancestors() if a.tag == "table" or a.parent is None)
        if owner is table:
            rows.append([c for c in tr.children if isinstance(c, Node) and c.tag in ("td", "th")])
    return rows


def is_category(cells: list[Node]) -> bool:
    """A row whose texts are all equal, so also any row of one cell."""
    return bool(cells) and len({c.text() for c in cells}) == 1


def header_first(rows: list[list[Node]]) -> list[list[Node]]:
    """The first row with cells that is no category row comes first; the others keep their order."""
    at = next((i for i, cells in enumerate(rows) if cells and not is_category(cells)), 0)
    return [*rows[at : at + 1], *rows[:at], *rows[at + 1 :]]


def expand(rows: list[list[Node]]) -> list[list[str | None]]:
    """The grid of texts, spans written out; short rows are filled with None."""
    grid: list[list[str | None]] = []
    down: dict[int, tuple[int, str]] = {}
    for cells in rows:
        line: list[str | None] = []
        left, queue = dict(down), iter(cells)
        down = {}
        cell = next(queue, None)
        while cell is not None or any(c >= len(line) for c in left):
            at = len(line)
            if at in left:
                n, text = left.pop(at)
                line.append(text)
                if n > 1:
                    down[at] = (n - 1, text)
            elif cell is None:
                line.append(None)
            else:
                text, high = cell.spaced_text(), span(cell.attrs.get("rowspan"), len(rows))
                for _ in range(span(cell.attrs.get("colspan"))):
                    if high > 1:
                        down[len(line)] = (high - 1, text)
                    line.append(text)
                cell = next(queue, None)
        grid.append(line)
    width = max(map(len, grid), default=0)
    return [line + [None] * (width - len(line)) for line in grid]


def column_names(first: list[str | None]) -> list[str]:
    """Header texts; blank ones as ``Unnamed: k``, repeated ones with ``.1``, ``.2``."""
    seen: dict[str, int] = {}
    names = []
    for i, text in enumerate(first):
        name = text or f"Unnamed: {i}"
        n = seen.get(name, 0)
        seen[name] = n + 1
        names.append(f"{name}.{n}" if n else name)
    return names


_TABLE_FIELDS = (
    "table_no int, h2 string, h3 string, h4 string, nested boolean, navbox boolean, classes array<string>, parent_classes array<string>, "
    "first_text string, row_idx int, cells array<struct<pos:int,name:string,value:string>>"
)


_TABLE_TYPES = (
    pa.field("table_no", pa.int32()), pa.field("h2", pa.string()), pa.field("h3", pa.string()), pa.field("h4", pa.string()),
    pa.field("nested", pa.bool_()), pa.field("navbox", pa.bool_()), pa.field("classes", pa.list_(pa.string())),
    pa.field("parent_classes", pa.list_(pa.string())), pa.field("first_text", pa.string()), pa.field("row_idx", pa.int32()),
    pa.field("cells", pa.list_(pa.struct([("pos", pa.int32()), ("name", pa.string()), ("value", pa.string())]))),
)


def page_tables(html: str | None) -> Iterator[dict]:
    """One dict per data row of each table, or one with ``row_idx`` None for a table without any."""
    heads: dict[str, str | None] = {"h2": None, "h3": None, "h4": None}
    number = 0
    for node in parse(html).walk():
        if node.tag == "h2":
            heads = {"h2": node.text(), "h3": None, "h4": None}
        elif node.tag in heads:
            heads[node.tag] = node.text()
        elif node.tag == "table":
            rows = own_rows(node)
            first = next(node.find_all("tr"), None)
            cell = next(first.find_all("td", "th"), None) if first else None
            above = list(node.ancestors())
            info = {
                "table_no": number, **heads,
                "nested": any(a.tag == "table" for a in above),
                "navbox": any(a.tag == "div" and a.attrs.get("role") == "navigation" and "navbox" in a.classes for a in above),
                "classes": node.classes, "parent_classes": above[0].classes if above else [],
                "first_text": cell.text().lower() if cell else "",
            }
            number += 1
            grid = expand(header_first(rows)) if rows else []
            names = column_names(grid[0]) if grid else []
            body = grid[1:]
            for i, line in enumerate(body):
                yield info | {"row_idx": i, "cells": [{"pos": p, "name": n, "value": v or None} for p, (n, v) in enumerate(zip(names, line))]}
            if not body:
                yield info | {"row_idx": None, "cells": [{"pos": p, "name": n, "value": None} for p, n in enumerate(names)]}


def extract_tables(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "country", "url"), html: str = "html", clean: bool = True) -> DataFrame:
    """All tables of all pages with their context: ``<keep>`` and the fields of :func:`page_tables`.

    NULL pages give nothing. Broken markup is closed as browsers close it.
    """
    text = clean_html(F.col(html)) if clean else F.col(html)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types: pa.Schema | None = None
        for batch in batches:
            if types is None:
                types = pa.schema([*list(batch.schema)[:-1], *_TABLE_TYPES])
            rows: list[dict] = []
            for i in range(batch.num_rows):
                page = {k: batch.column(k)[i].as_py() for k in keep}
                for r in page_tables(batch.column("__html")[i].as_py()):
                    rows.append(page | r)
                    if len(rows) >= 2000:  # a page may hold very many rows
                        yield pa.RecordBatch.from_pylist(rows, types)
                        rows = []
            if rows:
                yield pa.RecordBatch.from_pylist(rows, types)

    chosen = pages.select(*keep, text.alias("__html")).where("__html IS NOT NULL")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[:-1])
    return chosen.mapInArrow(run, f"{kinds}, {_TABLE_FIELDS}")


def is_junk(title: Column, nested: Column, navbox: Column, classes: Column, parent_classes: Column, first_text: Column) -> Column:
    """Titles with a listed word, tables within tables or navigation boxes, listed classes, listed first texts."""
    low = F.lower(F.coalesce(title, F.lit("")))
    titled = F.exists(F.array(*map(F.lit, TITLE_WORDS)), lambda w: F.contains(low, w))
    boxed = F.exists(classes, lambda c: c.isin(*TABLE_CLASSES) | c.endswith("mbox"))
    return titled | nested | navbox | F.exists(parent_classes, lambda c: c.isin(*PARENT_CLASSES)) | boxed | first_text.isin(*FIRST_TEXTS)


def wanted_tables(extracted: DataFrame, page: str = "page_id") -> DataFrame:
    """Rows of tables that aren't junk, numbered per page over the kept ones, with title and key."""
    titled = extracted.withColumn("section_title", section_title(F.col("h2"), F.col("h3"), F.col("h4")))
    kept = titled.where(~is_junk(*[F.col(c) for c in ("section_title", "nested", "navbox", "classes", "parent_classes", "first_text")]))
    # one page's tables are numbered together; pages are parsed once
    numbered = kept.where(F.size("cells") > 0).withColumn("table_idx", F.dense_rank().over(W.partitionBy(page).orderBy("table_no")) - 1)
    return numbered.withColumn("table_name", table_key(F.col("country"), F.col("table_idx"), F.col("section_title")))


def page_links(html: str | None) -> Iterator[tuple[str, str, str, int]]:
    """(heading, text, href, position) of the first link of each list item in sections with a second-level heading."""
    pos = 0
    for section in parse(html).find_all("section"):
        head = next(section.find_all("h2"), None)
        if head is None:
            continue
        for li in section.find_all("li"):
            a = next((a for a in li.find_all("a") if "href" in a.attrs), None)
            if a is not None:
                yield head.text(), a.text(), a.attrs["href"], pos
                pos += 1


def extract_links(pages: DataFrame, base: str, html: str = "html") -> DataFrame:
    """``country, page_title, url, link_pos``: article links of a list page, made absolute.

    Links to ``base`` with or without scheme count as inner ones; only inner
    ``/wiki/`` paths without a colon are kept.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [link for text in batch.column(0) for link in page_links(text.as_py())]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.string(), pa.string(), pa.int32()))]
            if rows:
                yield pa.RecordBatch.from_arrays(columns, ["country", "page_title", "href", "link_pos"])

    found = pages.select(F.col(html).alias("__html")).where("__html IS NOT NULL").mapInArrow(run, "country string, page_title string, href string, link_pos int")
    host = base.split("://", 1)[-1].replace(".", r"\.")
    inner = F.regexp_replace("href", rf"^(?:https?:)?//{host}(?=/wiki/)", "")
    return (
        found.withColumn("href", inner)
        .where(F.startswith("href", F.lit("/wiki/")) & ~F.contains("href", F.lit(":")))
        .select("country", "page_title", F.concat(F.lit(base), F.col("href")).alias("url"), "link_pos")
    )


def read_pages(spark, path: str, country: str | None = None) -> DataFrame:
    """Pages from files, one each; fetching stays outside the engine."""
    files = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("url"))
    return files.select(F.xxhash64("url").alias("page_id"), F.lit(country).alias("country"), "url", F.col("value").alias("html"))
