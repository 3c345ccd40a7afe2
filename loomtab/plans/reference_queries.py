"""Queries over the engine's own operators, each with its SQL oracle where SQL can say the same."""

from __future__ import annotations

import unicodedata

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtab.functions import quantity as Q
from loomtab.functions import text as X
from loomtab.operators import classification, cleaning, drift, legacy, mapping, refine, summary, taxonomy
from loomtab.schemas import CANONICAL_COLUMNS, MAPPED_FIELDS
from loomtab.session import cut_lineage, read_table
from loomtab.sources import files, html

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
ROOT = "Inventory"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


# --- aggregates, filters, views -----------------------------------------------------------------------------------


@query("""
SELECT country, class_path, sub_class, sum(quantity_clean)::BIGINT AS total_quantity FROM a_canonical_equipment
WHERE quantity_clean IS NOT NULL AND class_path IS NOT NULL AND sub_class IS DISTINCT FROM 'Inventory' GROUP BY 1, 2, 3""")
def summary_by_key(spark: SparkSession, d: str) -> DataFrame:
    return summary.summarise(read_table(spark, d, "a_canonical_equipment"), hidden=ROOT)


@query("""
SELECT n_name AS country, concat_ws('>', p_type, p_brand) AS class_path, p_brand AS sub_class, sum(l_quantity::BIGINT)::BIGINT AS total_quantity
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey
WHERE p_brand IS DISTINCT FROM 'Brand#11' GROUP BY 1, 2, 3""")
def summary_by_supplier(spark: SparkSession, d: str) -> DataFrame:
    """The summary over a star join: quantities arrive as text and are read back."""
    lines = read_table(spark, d, "lineitem").select("l_suppkey", "l_partkey", F.col("l_quantity").cast("bigint").cast("string").alias("quantity"))
    where = read_table(spark, d, "supplier").join(read_table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    parts = read_table(spark, d, "part").select("p_partkey", F.concat_ws(">", "p_type", "p_brand").alias("class_path"), F.col("p_brand").alias("sub_class"))
    rows = lines.join(where.select("s_suppkey", F.col("n_name").alias("country")), F.col("l_suppkey") == F.col("s_suppkey")).join(
        parts, F.col("l_partkey") == F.col("p_partkey")
    )
    return summary.summarise(rows.withColumn("quantity_clean", Q.clean_quantity(F.col("quantity"))), hidden="Brand#11")


@query("SELECT row_id, sub_class FROM a_canonical_equipment WHERE sub_class IS DISTINCT FROM 'Inventory'")
def null_safe_exclude(spark: SparkSession, d: str) -> DataFrame:
    rows = read_table(spark, d, "a_canonical_equipment").select("row_id", "sub_class")
    return rows.where(~F.col("sub_class").eqNullSafe(F.lit(ROOT)))


_BINS = {"Sea": ("Naval craft", "Patrol boat", "Light frigate"), "Air and space": ("Air fleet", "Airship")}
_BIN_SQL = "CASE WHEN sub_class IN ('Naval craft', 'Patrol boat', 'Light frigate') THEN 'Sea' WHEN sub_class IN ('Air fleet', 'Airship') THEN 'Air and space' ELSE sub_class END"


@query(f"SELECT {_BIN_SQL} AS bin, count(*) AS n, sum(quantity_clean)::BIGINT AS total FROM a_canonical_equipment GROUP BY 1")
def class_bins(spark: SparkSession, d: str) -> DataFrame:
    rows = read_table(spark, d, "a_canonical_equipment")
    return rows.groupBy(summary.class_bin(F.col("sub_class"), _BINS).alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.sum("quantity_clean").alias("total"))


@query(f"""
SELECT country, sum(quantity_clean) FILTER ({_BIN_SQL} = 'Sea')::BIGINT AS "Sea",
  sum(quantity_clean) FILTER ({_BIN_SQL} = 'Air and space')::BIGINT AS "Air and space" FROM a_canonical_equipment GROUP BY 1""")
def crosstab_country_bin(spark: SparkSession, d: str) -> DataFrame:
    rows = read_table(spark, d, "a_canonical_equipment").withColumn("bin", summary.class_bin(F.col("sub_class"), _BINS))
    return summary.crosstab(rows, "country", "bin", "quantity_clean", list(_BINS))


_PAIRS = [("Södervik", "Naval craft"), ("L'Orme", "Air fleet")]


@query("""
SELECT row_id, country, sub_class FROM a_canonical_equipment
WHERE coalesce(NOT ((country = 'Södervik' AND sub_class = 'Naval craft') OR (country = 'L''Orme' AND sub_class = 'Air fleet')), true)""")
def pair_exclusion(spark: SparkSession, d: str) -> DataFrame:
    return summary.exclude_pairs(read_table(spark, d, "a_canonical_equipment").select("row_id", "country", "sub_class"), _PAIRS, ("country", "sub_class"))


@query("SELECT row_id, status FROM a_canonical_equipment WHERE status IS NULL OR status IN ('active', 'retired')")
def member_filter(spark: SparkSession, d: str) -> DataFrame:
    return summary.include_members(read_table(spark, d, "a_canonical_equipment").select("row_id", "status"), "status", ["active", "retired", None])


@query("""
SELECT sub_class, count(*) AS n, CASE WHEN sub_class IS NULL THEN 0 WHEN sub_class = 'Air fleet' THEN 1 WHEN sub_class = 'Naval craft' THEN 2 ELSE 3 END AS rank
FROM a_canonical_equipment GROUP BY 1""")
def manual_order(spark: SparkSession, d: str) -> DataFrame:
    n = read_table(spark, d, "a_canonical_equipment").groupBy("sub_class").agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("rank", summary.manual_order(F.col("sub_class"), [None, "Air fleet", "Naval craft"]))


# --- scalar functions ---------------------------------------------------------------------------------------------

_SHIPS = """(contains(ship_name, ',') OR contains(ship_name, ';')
  OR len(regexp_extract_all(ship_name, 'USS')) > 1 OR len(regexp_extract_all(ship_name, 'HMS')) > 1 OR len(regexp_extract_all(ship_name, 'HS')) > 1
  OR len(regexp_extract_all(ship_name, 'INS')) > 1 OR len(regexp_extract_all(ship_name, 'ČMP')) > 1 OR len(regexp_extract_all(ship_name, 'KRI')) > 1
  OR len(regexp_extract_all(ship_name, 'HMAS')) > 1 OR len(regexp_extract_all(ship_name, '\\(')) > 1
  OR len(regexp_extract_all(ship_name, '\\b[A-Z][a-zA-Z]+\\b')) > 2)"""


@query(f"""
WITH q AS (SELECT row_id, quantity, nullif(ship_name, '') AS ship_name,
  list_filter(list_transform(regexp_extract_all(quantity, '\\d+'), lambda x: TRY_CAST(x AS BIGINT)), lambda x: x IS NOT NULL) AS nums FROM a_canonical_equipment),
k AS (SELECT *, list_filter(nums, lambda x: x NOT BETWEEN 1950 AND 2050) AS kept FROM q),
f AS (SELECT *, CASE WHEN len(kept) > 0 THEN kept ELSE nums END AS n FROM k)
SELECT row_id, CASE WHEN quantity IS NULL OR trim(quantity) = '' THEN NULL WHEN coalesce({_SHIPS}, false) THEN 1
  WHEN ship_name IS NOT NULL AND len(n) > 1 THEN coalesce(TRY_CAST(nullif(regexp_extract(quantity, '\\((\\d+)\\)', 1), '') AS BIGINT), 1)
  ELSE list_min(n) END::BIGINT AS quantity_read FROM f""")
def quantity_from_text(spark: SparkSession, d: str) -> DataFrame:
    rows = read_table(spark, d, "a_canonical_equipment")
    return rows.select("row_id", Q.clean_quantity(F.col("quantity"), F.col("ship_name")).alias("quantity_read"))


@query(f"SELECT row_id, coalesce({_SHIPS}, false) AS several FROM (SELECT row_id, equip_type AS ship_name FROM a_master_equipment)")
def several_names_flag(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "a_master_equipment").select("row_id", Q.has_several_names(F.col("equip_type")).alias("several"))


_SLUG = "trim(regexp_replace(lower({0}), '[^a-z0-9]+', '_', 'g'), '_')"


@query(f"""
SELECT meta_id, {_SLUG.format("country")} || '_table_' || printf('%02d', table_idx) || '_' || {_SLUG.format("section_title")} AS key FROM a_meta_table""")
def table_keys(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "a_meta_table").select("meta_id", X.table_key(F.col("country"), F.col("table_idx"), F.col("section_title")).alias("key"))


@query("""
SELECT meta_id, coalesce(nullif(concat_ws('_', nullif(section_h2, ''), nullif(section_h3, ''), nullif(section_h4, '')), ''), 'untitled') AS title FROM a_meta_table""")
def section_titles(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "a_meta_table").select("meta_id", X.section_title(*map(F.col, ("section_h2", "section_h3", "section_h4"))).alias("title"))


@query("SELECT meta_id, CASE WHEN instr(table_name, '_table_') > 0 THEN substr(table_name, 1, instr(table_name, '_table_') - 1) ELSE '' END AS country FROM a_meta_table")
def country_of_key(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "a_meta_table").select("meta_id", X.country_of_key(F.col("table_name")).alias("country"))


@query("""
SELECT node_id, CASE WHEN ends_with(w, 's') AND NOT ends_with(w, 'ss') THEN w[:-2] ELSE w END AS singular
FROM (SELECT node_id, lower(name) || 's' AS w FROM taxonomy_nodes)""")
def singular_names(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "taxonomy_nodes").select("node_id", X.singularize(F.concat(F.lower("name"), F.lit("s"))).alias("singular"))


_WIDE = "translate({0}, '" + "".join(chr(i + 0xFEE0) for i in range(0x21, 0x7F)).replace("'", "''") + "\u3000\u2011', '" + "".join(chr(i) for i in range(0x21, 0x7F)).replace("'", "''") + " \u2010')"
#: Tidy text in SQL: no signs without width, no control signs, single spaces, trimmed, lower case.
_TIDY = (
    r"lower(trim(regexp_replace(regexp_replace({0}, '[\x{{200B}}\x{{200C}}\x{{200D}}\x{{FEFF}}\x{{00AD}}\x{{0000}}-\x{{001F}}\x{{007F}}]', '', 'g'), '[\s\p{{Z}}]+', ' ', 'g')))"
)


@query("SELECT meta_id, " + ", ".join(_TIDY.format("nfc_normalize(" + _WIDE.replace("{0}", h) + ")") + f" AS {h}" for h in classification.HEADINGS) + " FROM a_meta_table")
def normal_headings(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "a_meta_table").select("meta_id", *[X.normalize_text(F.col(h)).alias(h) for h in classification.HEADINGS])


def _composed(column: str) -> str:
    """NFKC in SQL, for full-width forms and the signs that come as several (DuckDB itself only has NFC)."""
    sql = _WIDE.replace("{0}", column)
    for sign in "ﬀﬁﬂﬃﬄ¼½¾²³¹ªº™…№":
        sql = f"replace({sql}, '{sign}', '{unicodedata.normalize('NFKC', sign)}')"
    return f"nfc_normalize({sql})"


def _page_text_sql() -> str:
    sql = _composed("text")
    for rx, to in (
        (r"\[[0-9a-zA-Z ]{1,10}\]", ""), (r"(?is)<sup\b[^>]*>.*?</sup>", ""), (r'(?is)<span[^>]*class="[^"]*mw-editsection[^"]*"[^>]*>.*?</span>', ""),
        (r"(?s)<!--.*?-->", ""), (r"[\s\p{Z}\x{0085}\x{000B}\x{001C}-\x{001F}]+", " "),
    ):
        sql = f"regexp_replace({sql}, '{rx}', '{to}', 'g')"
    return f"SELECT doc_id, trim({sql}) AS text FROM documents"


@query(_page_text_sql())
def clean_page_text(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "documents").select("doc_id", X.clean_html(F.col("text")).alias("text"))


@query("""
SELECT row_id, quantity IS NOT NULL AND (regexp_full_match(lower(trim(quantity)), '\\d+') OR regexp_matches(lower(trim(quantity)), '\\(\\d+\\)$')
  OR regexp_matches(lower(trim(quantity)), '(active|in service|total)\\s*\\(\\d+\\)')) AS is_quantity FROM a_canonical_equipment""")
def quantity_test(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "a_canonical_equipment").select("row_id", F.coalesce(X.is_quantity(F.col("quantity")), F.lit(False)).alias("is_quantity"))


@query("SELECT meta_id, coalesce(TRY_CAST(regexp_replace(section_h3, '[^0-9]', '', 'g') AS INT), 1) AS n FROM a_meta_table")
def safe_integers(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "a_meta_table").select("meta_id", X.safe_int(F.col("section_h3")).alias("n"))


# --- cleaning over the long form ----------------------------------------------------------------------------------


def _rows(spark: SparkSession, d: str) -> DataFrame:
    return cleaning.from_scrapes(read_table(spark, d, "raw_rows"))


_KIND = """CASE WHEN len(v) = 0 THEN 'empty' WHEN len(v) > 1 THEN 'data' WHEN v[1] = '' THEN 'empty'
  WHEN regexp_matches(lower(v[1]), '^\\d+$|\\(\\d+\\)$|(active|in service|total)\\s*\\(\\d+\\)') THEN 'quantity' ELSE 'section' END"""
_VALUES = "SELECT meta_id, row_idx, list_distinct(list_transform(cells, lambda c: trim(coalesce(c.value, '')))) AS v FROM raw_rows"


@query(f"SELECT {_KIND} AS kind, count(*) AS n FROM ({_VALUES}) GROUP BY 1")
def row_kinds(spark: SparkSession, d: str) -> DataFrame:
    return _rows(spark, d).groupBy(cleaning.row_kind(F.col("cells")).alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@query("""
WITH c AS (SELECT meta_id, unnest(cells) AS c FROM raw_rows), n AS (SELECT meta_id, c.pos AS pos, min(c.name) AS name FROM c GROUP BY 1, 2)
SELECT meta_id::VARCHAR AS table_name, name AS column_name, (row_number() OVER (PARTITION BY meta_id ORDER BY pos) - 1)::INT AS pos FROM n
QUALIFY name IS NOT NULL AND lower(name) NOT IN ('', 'null')""")
def column_list(spark: SparkSession, d: str) -> DataFrame:
    return cleaning.column_list(_rows(spark, d))


@query("""
SELECT meta_id::VARCHAR AS table_name, row_idx, list_filter(cells, lambda c: NOT regexp_matches(lower(trim(c.name)),
  'image|photo|thumbnail|file|picture|illustration|portrait|insignia|^unnamed|^\\d+$')).len()::INT AS n_cells FROM raw_rows""")
def superfluous_columns(spark: SparkSession, d: str) -> DataFrame:
    return cleaning.drop_superfluous(_rows(spark, d)).select("table_name", "row_idx", F.size("cells").alias("n_cells"))


@query("""
WITH c AS (SELECT meta_id, row_idx, unnest(cells) AS c, len(cells) AS n FROM raw_rows),
one AS (SELECT meta_id, max(n) AS n FROM c GROUP BY 1),
h AS (SELECT meta_id, row_idx, c.pos AS pos, c.value AS value, bool_or(c.value IS NOT NULL) OVER (PARTITION BY meta_id, row_idx) AS any_value FROM c)
SELECT meta_id::VARCHAR AS table_name, pos, count(*) * 2 AS n, count(value) * 2 AS n_values FROM h WHERE any_value GROUP BY 1, 2""")
def doublewide_split(spark: SparkSession, d: str) -> DataFrame:
    """Each table is laid beside itself and split again: twice the rows under the left names."""
    wide = _rows(spark, d).withColumn(
        "cells",
        F.concat(
            F.transform("cells", lambda c: F.struct(c["pos"].alias("pos"), c["name"].alias("name"), c["value"].alias("value"))),
            F.transform("cells", lambda c: F.struct((c["pos"] + F.size("cells")).alias("pos"), F.concat(c["name"], F.lit(".1")).alias("name"), c["value"].alias("value"))),
        ),
    )
    cells = cleaning.split_doublewide(wide).select("table_name", F.inline("cells"))
    return cells.groupBy("table_name", "pos").agg(F.count(F.lit(1)).alias("n"), F.count("value").alias("n_values"))


@query("""
WITH e AS (SELECT user_id, event_id, event_type, event_type IN ('signup', 'logout', 'search') AS meta,
  CASE WHEN event_type IN ('signup', 'logout', 'search') THEN struct_pack(s := trim(regexp_replace(t, '\\(\\d+\\)', '', 'g')), q := nullif(regexp_extract(t, '\\(\\d+\\)'), '')) END AS told
  FROM (SELECT *, CASE WHEN event_id % 2 = 0 THEN event_type || ' (' || (event_id % 7) || ')' ELSE event_type END AS t FROM events)),
f AS (SELECT *, last_value(told IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS l,
  bool_or(meta) OVER (PARTITION BY user_id) AS has_s, bool_or(meta AND event_id % 2 = 0) OVER (PARTITION BY user_id) AS has_q FROM e)
SELECT user_id::VARCHAR AS table_name, (row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1)::INT AS row_idx,
  CASE WHEN has_s THEN l.s END AS section, CASE WHEN has_q THEN l.q END AS quantity FROM f WHERE NOT meta""")
def section_forward_fill(spark: SparkSession, d: str) -> DataFrame:
    """Events as rows of a table per user; some types are section rows, every other one with a count."""
    e = read_table(spark, d, "events")
    meta = F.col("event_type").isin("signup", "logout", "search")
    told = F.when(F.col("event_id") % 2 == 0, F.concat("event_type", F.lit(" ("), (F.col("event_id") % 7).cast("string"), F.lit(")"))).otherwise(F.col("event_type"))
    values = F.when(meta, F.array(told, told)).otherwise(F.array("event_type", F.lit("x")))
    cells = F.transform(values, lambda v, i: F.struct(i.cast("int").alias("pos"), F.concat(F.lit("c"), i.cast("string")).alias("name"), v.alias("value")))
    rows = e.select(F.col("user_id").cast("string").alias("table_name"), F.col("event_id").alias("row_idx"), cells.alias("cells"))
    return cleaning.propagate_sections(rows).select("table_name", "row_idx", "section", "quantity")


def _cleaned_sql() -> str:
    """All steps of cleaning in SQL, but for double-wide tables and headers of several levels, which the test tables don't have (``doublewide_split`` makes some)."""
    picture = "(" + "|".join(cleaning.IMAGE_WORDS) + r")|^unnamed|^\d+$"
    return f"""WITH c AS (SELECT meta_id, row_idx, unnest(cells) AS c FROM raw_rows),
n AS (SELECT meta_id, c.pos AS pos, {_TIDY.format("min(c.name)")} AS name FROM c GROUP BY 1, 2),
kept AS (SELECT c.meta_id, row_idx, n.pos, n.name, c.c.value AS value FROM c JOIN n ON n.meta_id = c.meta_id AND n.pos = c.c.pos WHERE NOT coalesce(regexp_matches(n.name, '{picture}'), false)),
cells AS (SELECT meta_id, row_idx, list(struct_pack(name := name, value := value) ORDER BY pos) AS cells FROM kept GROUP BY 1, 2),
v AS (SELECT r.meta_id, r.row_idx, coalesce(k.cells, []) AS cells, list_distinct(list_transform(coalesce(k.cells, []), lambda x: trim(coalesce(x.value, '')))) AS v FROM raw_rows r LEFT JOIN cells k USING (meta_id, row_idx)),
kinds AS (SELECT meta_id, row_idx, cells, {_KIND} AS kind, trim(coalesce(cells[1].value, '')) AS text FROM v),
told AS (SELECT *, CASE WHEN kind IN ('section', 'quantity') THEN struct_pack(s := trim(regexp_replace(text, '\\(\\d+\\)', '', 'g')), q := nullif(regexp_extract(text, '\\(\\d+\\)'), '')) END AS told FROM kinds),
filled AS (SELECT *, last_value(told IGNORE NULLS) OVER (PARTITION BY meta_id ORDER BY row_idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS l,
  bool_or(kind IN ('section', 'quantity')) OVER (PARTITION BY meta_id) AS has_s, bool_or(kind = 'quantity') OVER (PARTITION BY meta_id) AS has_q FROM told),
data AS (SELECT meta_id, (row_number() OVER (PARTITION BY meta_id ORDER BY row_idx) - 1)::INT AS row_idx,
  list_concat(CASE WHEN has_s THEN [struct_pack(name := 'section', value := l.s)] ELSE [] END, CASE WHEN has_q THEN [struct_pack(name := 'quantity', value := l.q)] ELSE [] END,
    list_filter(cells, lambda x: NOT ((has_s AND x.name = 'section') OR (has_q AND x.name = 'quantity')))) AS cells FROM filled WHERE kind = 'data')
SELECT meta_id::VARCHAR AS table_name, row_idx, array_to_string(list_transform(cells, lambda x: x.name || '=' || coalesce(x.value, '∅')), '|') AS cells FROM data
WHERE meta_id IN (SELECT meta_id FROM (SELECT meta_id, unnest(cells) AS x FROM data) WHERE NOT regexp_matches(lower(trim(x.name)), '^(\\d+$|unnamed|col_)'))"""


@query(_cleaned_sql())
def cleaned_tables(spark: SparkSession, d: str) -> DataFrame:
    rows = cleaning.clean_all(_rows(spark, d))
    told = F.transform("cells", lambda c: F.concat(c["name"], F.lit("="), F.coalesce(c["value"], F.lit("∅"))))
    return rows.select("table_name", "row_idx", F.array_join(told, "|").alias("cells"))


@query("""
WITH n AS (SELECT meta_id, pos, lower(trim(replace(column_name, '_', ' '))) AS name FROM a_meta_table_of_columns),
r AS (SELECT *, row_number() OVER (PARTITION BY meta_id, name ORDER BY pos) AS k FROM n)
SELECT meta_id, pos, CASE WHEN k > 1 THEN name || '_' || k ELSE name END AS name FROM r""")
def occurrence_suffix(spark: SparkSession, d: str) -> DataFrame:
    cols = read_table(spark, d, "a_meta_table_of_columns")
    named = cols.select("meta_id", "pos", F.lower(F.trim(F.translate("column_name", "_", " "))).alias("name"))
    return files.numbered_occurrences(named, "meta_id", "pos", "name")


@query("""
WITH t AS (SELECT meta_id, pos, lower(column_name) AS name FROM a_meta_table_of_columns),
f AS (SELECT name, min((meta_id, pos)) AS rank FROM t GROUP BY 1), u AS (SELECT DISTINCT meta_id, name FROM t)
SELECT meta_id::VARCHAR AS table_name, list(name ORDER BY rank) AS names FROM u JOIN f USING (name) GROUP BY 1""")
def first_seen_order(spark: SparkSession, d: str) -> DataFrame:
    cols = read_table(spark, d, "a_meta_table_of_columns")
    return cleaning.global_first_seen(
        cols.select(F.col("meta_id").cast("string").alias("table_name"), F.col("meta_id").alias("table_seq"), "pos", F.lower("column_name").alias("column_name"))
    )


_TYPES = ("TEXT", "BIGINT", "DATE", "DOUBLE")


@query("SELECT meta_id, " + ", ".join(f"count(*) FILTER (value_type = '{t}') AS \"{t}\"" for t in _TYPES) + " FROM a_meta_table_of_columns GROUP BY 1")
def pivot_types(spark: SparkSession, d: str) -> DataFrame:
    cols = read_table(spark, d, "a_meta_table_of_columns")
    return cols.groupBy("meta_id").pivot("value_type", list(_TYPES)).agg(F.count(F.lit(1))).fillna(0)


_FAMILY = "CASE trim(regexp_replace(lower(value_type), '[\\[(<].*$', '')) " + " ".join(f"WHEN '{n}' THEN '{f}'" for f, ns in drift.FAMILIES.items() for n in ns) + " ELSE 'unknown' END"


@query("SELECT meta_id, " + ", ".join(f"count(*) FILTER ({_FAMILY} = '{f}') AS \"{f}\"" for f in (*drift.FAMILIES, "unknown")) + " FROM a_meta_table_of_columns GROUP BY 1")
def pivot_type_families(spark: SparkSession, d: str) -> DataFrame:
    """Every typed or untyped column counts once, however its type is spelled."""
    cols = read_table(spark, d, "a_meta_table_of_columns").select("meta_id", F.coalesce(drift.type_family(F.col("value_type")), F.lit("unknown")).alias("family"))
    return cols.groupBy("meta_id").pivot("family", [*drift.FAMILIES, "unknown"]).agg(F.count(F.lit(1))).fillna(0)


@query("""
SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (PARTITION BY table_name ORDER BY scrape_timestamp DESC, meta_id DESC) AS k FROM a_meta_table) WHERE k = 1""")
def upsert_last_wins(spark: SparkSession, d: str) -> DataFrame:
    return files.last_wins(read_table(spark, d, "a_meta_table"), "table_name", ("scrape_timestamp", "meta_id"))


@query("SELECT meta_id, table_name FROM a_meta_table WHERE table_name NOT IN (SELECT table_name FROM a_meta_table WHERE section_h2 IS NULL)")
def drop_tables(spark: SparkSession, d: str) -> DataFrame:
    meta = read_table(spark, d, "a_meta_table").select("meta_id", "table_name", "section_h2")
    return files.drop_tables(meta, meta.where("section_h2 IS NULL")).drop("section_h2")


# --- taxonomy and rules -------------------------------------------------------------------------------------------


@query("""
WITH RECURSIVE p(name, path) AS (SELECT name, [name] FROM taxonomy_nodes WHERE parent IS NULL
  UNION ALL SELECT n.name, list_append(p.path, n.name) FROM taxonomy_nodes n JOIN p ON n.parent = p.name)
SELECT name, path[1] AS root, (len(path) - 1)::INT AS depth, array_to_string(path, '>') AS class_path FROM p""")
def taxonomy_paths(spark: SparkSession, d: str) -> DataFrame:
    p = taxonomy.paths(read_table(spark, d, "taxonomy_nodes"))
    return p.select("name", "root", "depth", taxonomy.path_text(F.col("path")).alias("class_path"))


@query("""
WITH c AS (SELECT m.country, n.path FROM a_mapping_table m JOIN taxonomy_nodes n ON m.equipment_class = n.name),
d AS (SELECT country, k, count(DISTINCT coalesce(path[k], '∅')) AS n, min(path[k]) AS name, min(len(path)) AS least FROM c, range(1, 12) t(k) GROUP BY 1, 2),
ok AS (SELECT country, k, name, n = 1 AND k <= least AS good FROM d)
SELECT country, max_by(name, k) AS nearest FROM ok o WHERE good AND NOT EXISTS (SELECT 1 FROM ok x WHERE x.country = o.country AND x.k < o.k AND NOT x.good) GROUP BY 1""")
def nearest_common_ancestor(spark: SparkSession, d: str) -> DataFrame:
    """The nearest common ancestor of all classes of a country's tables."""
    paths = taxonomy.paths(read_table(spark, d, "taxonomy_nodes")).select(F.col("name").alias("equipment_class"), "path")
    joined = read_table(spark, d, "a_mapping_table").select("country", "equipment_class").distinct().join(paths, "equipment_class")
    return joined.groupBy("country").agg(taxonomy.nearest_common_ancestor(F.collect_set("path")).alias("nearest"))


def _heading_texts(spark: SparkSession, d: str) -> DataFrame:
    meta = read_table(spark, d, "a_meta_table")
    return meta.select(F.explode(F.array(*classification.HEADINGS)).alias("text")).where("text IS NOT NULL AND text <> ''")


_RULE_SQL = r"""rules AS (SELECT name AS entity, '(?i)\b' || regexp_replace(regexp_replace(lower(name), '([.()\[\]^$*+?|\\{}-])', '\\\1', 'g'), 's$', '') || 's?\b' AS pattern FROM taxonomy_nodes),
texts AS (SELECT DISTINCT text FROM (SELECT unnest([section_h2, section_h3, section_h4]) AS text FROM a_meta_table) WHERE text IS NOT NULL AND text <> ''),
hits AS (SELECT text, entity FROM texts JOIN rules ON regexp_matches(lower(text), pattern))"""


@query(f"WITH {_RULE_SQL} SELECT text, entity FROM hits")
def classify_by_rules(spark: SparkSession, d: str) -> DataFrame:
    rules = taxonomy.name_rules(read_table(spark, d, "taxonomy_nodes"))
    return taxonomy.match_rules(_heading_texts(spark, d), rules).select("text", "entity")


def _classified(spark: SparkSession, d: str, collapse: str = "none") -> DataFrame:
    nodes = read_table(spark, d, "taxonomy_nodes")
    hits = taxonomy.match_rules(_heading_texts(spark, d), taxonomy.name_rules(nodes))
    return classification.classify_by_headings(read_table(spark, d, "a_meta_table"), hits, taxonomy.paths(nodes), ROOT, collapse, key="meta_id")


@query(f"""
WITH {_RULE_SQL},
long AS (SELECT DISTINCT meta_id, entity FROM (SELECT meta_id, unnest([section_h2, section_h3, section_h4]) AS text FROM a_meta_table) JOIN hits USING (text)),
g AS (SELECT meta_id, list(entity ORDER BY entity) AS es FROM long GROUP BY 1)
SELECT m.meta_id, CASE WHEN len(es) = 1 THEN es[1] END AS equipment_class, CASE WHEN len(es) = 1 THEN 1.0 ELSE 0.0 END AS confidence,
  CASE WHEN len(es) = 1 THEN '' ELSE coalesce(array_to_string(es, ', '), '') END AS others,
  coalesce(nullif(section_h4, ''), nullif(section_h3, ''), nullif(section_h2, '')) AS leaf_header
FROM a_meta_table m LEFT JOIN g USING (meta_id)""")
def table_classes(spark: SparkSession, d: str) -> DataFrame:
    c = _classified(spark, d)
    return c.select("meta_id", "equipment_class", F.col("confidence"), F.array_join("other_classes", ", ").alias("others"), "leaf_header")


def _features(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    nodes = read_table(spark, d, "taxonomy_nodes")
    classified = _classified(spark, d, "leaf")
    columns = read_table(spark, d, "a_meta_table_of_columns").select("meta_id", F.lower(F.trim("column_name")).alias("column_name"))
    features = classification.table_features(classified, columns, nodes, key="meta_id")
    return classified, features, classification.starter_groups(nodes, taxonomy.paths(nodes), ROOT)


def _rounds_sql() -> str:
    """The rounds of classification by profile, one after the other."""
    leaf = "coalesce(nullif(section_h4, ''), nullif(section_h3, ''), nullif(section_h2, ''))"
    sql = f"""WITH {_RULE_SQL},
long AS (SELECT DISTINCT meta_id, entity FROM (SELECT meta_id, unnest([section_h2, section_h3, section_h4]) AS text FROM a_meta_table) JOIN hits USING (text)),
deep AS (SELECT l.meta_id, l.entity FROM long l JOIN taxonomy_nodes n ON n.name = l.entity
  WHERE NOT EXISTS (SELECT 1 FROM long o JOIN taxonomy_nodes m ON m.name = o.entity WHERE o.meta_id = l.meta_id AND len(m.path) > len(n.path) AND m.path[1:len(n.path)] = n.path)),
g AS (SELECT meta_id, list(entity ORDER BY entity) AS es FROM deep GROUP BY 1),
cl AS (SELECT m.meta_id, CASE WHEN len(es) = 1 THEN es[1] END AS cls, coalesce(es, []) AS es, {leaf} AS leaf FROM a_meta_table m LEFT JOIN g USING (meta_id)),
classes AS (SELECT meta_id, unnest(es) AS f FROM cl),
feats AS (SELECT DISTINCT * FROM (
  SELECT meta_id, 'classes' AS kind, f FROM classes
  UNION ALL SELECT meta_id, 'parent', n.parent FROM classes JOIN taxonomy_nodes n ON n.name = f WHERE n.parent IS NOT NULL
  UNION ALL SELECT meta_id, 'children', n.name FROM cl JOIN taxonomy_nodes n ON n.parent = cls
  UNION ALL SELECT meta_id, 'raw_cols', lower(trim(column_name)) FROM a_meta_table_of_columns JOIN (SELECT DISTINCT meta_id FROM cl) USING (meta_id) WHERE column_name IS NOT NULL
  UNION ALL SELECT meta_id, 'leaf_headers', leaf FROM cl WHERE leaf IS NOT NULL)),
starters AS (SELECT DISTINCT * FROM (
  SELECT name AS grp, 'classes' AS kind, name AS f FROM taxonomy_nodes WHERE path[1] = '{ROOT}' AND name <> '{ROOT}'
  UNION ALL SELECT name, 'parent', parent FROM taxonomy_nodes WHERE path[1] = '{ROOT}' AND name <> '{ROOT}'
  UNION ALL SELECT p.name, 'children', n.name FROM taxonomy_nodes p JOIN taxonomy_nodes n ON n.parent = p.name WHERE p.path[1] = '{ROOT}' AND p.name <> '{ROOT}')),
tf AS (SELECT DISTINCT meta_id, f FROM feats), tn AS (SELECT meta_id, sqrt(count(*)) AS n FROM tf GROUP BY 1),
a0 AS (SELECT meta_id, cls AS grp, 1.0::DOUBLE AS score FROM cl WHERE cls IS NOT NULL)"""
    for k, cut in enumerate(classification.CUTS, 1):
        sql += f""",
w{k} AS (SELECT grp, f, count(DISTINCT kind) AS w FROM (SELECT * FROM starters UNION ALL SELECT a.grp, kind, f FROM feats JOIN a{k - 1} a USING (meta_id)) GROUP BY 1, 2),
n{k} AS (SELECT grp, sqrt(sum(w * w)) AS n FROM w{k} GROUP BY 1),
s{k} AS (SELECT t.meta_id, w.grp, sum(w) / (any_value(tn.n) * any_value(g.n)) AS score FROM tf t JOIN w{k} w USING (f) JOIN n{k} g USING (grp) JOIN tn USING (meta_id)
  WHERE t.meta_id NOT IN (SELECT meta_id FROM a{k - 1}) GROUP BY 1, 2),
a{k} AS (SELECT * FROM a{k - 1} UNION ALL SELECT * FROM (SELECT meta_id, arg_min(grp, (-round(score, 12), grp)) AS grp, max(score) AS score FROM s{k} GROUP BY 1) WHERE score >= {cut!r})"""
    last = len(classification.CUTS)
    return sql + f""" SELECT meta_id, coalesce(cls, a.grp) AS equipment_class, round(coalesce(a.score, 0), 6) AS confidence FROM cl LEFT JOIN a{last} a USING (meta_id)"""


@query(_rounds_sql())
def table_profiles(spark: SparkSession, d: str) -> DataFrame:
    """Classes by headings, then by profile in rounds."""
    classified, features, groups = _features(spark, d)
    out = classification.classify_by_profile(cut_lineage(classified), features, groups, key="meta_id")
    return out.select("meta_id", "equipment_class", F.round("confidence", 6).alias("confidence"))


_COSINE = """
WITH cols AS (SELECT DISTINCT meta_id, lower(trim(column_name)) AS f FROM a_meta_table_of_columns),
g AS (SELECT m.equipment_class AS grp, c.f, 1 AS w FROM a_mapping_table m JOIN cols c USING (meta_id) WHERE m.equipment_class IS NOT NULL GROUP BY 1, 2),
gn AS (SELECT grp, sqrt(sum(w * w)) AS n FROM g GROUP BY 1), tn AS (SELECT meta_id, sqrt(count(*)) AS n FROM cols GROUP BY 1),
s AS (SELECT c.meta_id, g.grp, sum(w) / (any_value(tn.n) * any_value(gn.n)) AS score FROM cols c JOIN g USING (f) JOIN gn USING (grp) JOIN tn USING (meta_id) GROUP BY 1, 2)
"""


def _column_scores(spark: SparkSession, d: str) -> DataFrame:
    cols = read_table(spark, d, "a_meta_table_of_columns").select("meta_id", F.lit("raw_cols").alias("kind"), F.lower(F.trim("column_name")).alias("feature")).distinct()
    classes = read_table(spark, d, "a_mapping_table").where("equipment_class IS NOT NULL").select("meta_id", F.col("equipment_class").alias("grp"))
    groups = cols.join(classes, "meta_id").select("grp", "kind", "feature").distinct()
    return classification.profile_cosine(cols, groups, key="meta_id")


@query(_COSINE + "SELECT meta_id, grp, round(score, 6) AS score FROM s")
def profile_cosine(spark: SparkSession, d: str) -> DataFrame:
    return _column_scores(spark, d).withColumn("score", F.round("score", 6))


@query(_COSINE + "SELECT meta_id, arg_min(grp, (-round(score, 12), grp)) AS grp, round(max(score), 6) AS score FROM s GROUP BY 1")
def best_group(spark: SparkSession, d: str) -> DataFrame:
    return classification.best_group(_column_scores(spark, d), "meta_id").withColumn("score", F.round("score", 6))


# --- column mapping and the master table --------------------------------------------------------------------------

_LONG = " UNION ALL ".join(
    f"SELECT meta_id, '{f}' AS super_col, unnest(string_split({f}, ', ')) AS raw_col, unnest(range(len(string_split({f}, ', ')))) AS ord FROM a_mapping_table WHERE {f} IS NOT NULL AND {f} <> ''"
    for f in MAPPED_FIELDS
)


def _mapping(spark: SparkSession, d: str) -> DataFrame:
    report = read_table(spark, d, "a_mapping_table").withColumn("table_name", F.col("meta_id").cast("string"))
    return mapping.unpivot_report(report, MAPPED_FIELDS)


@query(f"SELECT meta_id::VARCHAR AS table_name, super_col, raw_col, ord::INT AS ord FROM ({_LONG})")
def mapping_long(spark: SparkSession, d: str) -> DataFrame:
    return _mapping(spark, d)


@query("SELECT meta_id::VARCHAR AS table_name, equipment_class, coalesce(other_classes, '') AS other_classes, confidence, "
       + ", ".join(f"nullif({f}, '') AS {f}" for f in MAPPED_FIELDS) + " FROM a_mapping_table")
def mapping_report(spark: SparkSession, d: str) -> DataFrame:
    """The report taken apart and built again."""
    t = read_table(spark, d, "a_mapping_table")
    heads = t.select(F.col("meta_id").cast("string").alias("table_name"), "equipment_class", F.split(F.coalesce("other_classes", F.lit("")), ", ").alias("other_classes"), "confidence")
    report = mapping.mapping_report(heads, _mapping(spark, d), MAPPED_FIELDS)
    return report.select("table_name", "equipment_class", "other_classes", "confidence", *[F.nullif(f, F.lit("")).alias(f) for f in MAPPED_FIELDS])


_NAMES = r"regexp_matches(raw_col, '(?i)^(name|ship$|model|make|family)$')"


@query(f"""
WITH hits AS (SELECT raw_col, list_sort(list(DISTINCT super_col)) AS h FROM ({_LONG}) GROUP BY 1),
c AS (SELECT meta_id, pos AS ord, lower(trim(column_name)) AS raw_col FROM a_meta_table_of_columns),
j AS (SELECT c.*, coalesce(h, []) AS h FROM c LEFT JOIN hits USING (raw_col)),
d AS (SELECT *, CASE WHEN raw_col = 'section' THEN 'sub_class' WHEN len(h) = 1 THEN h[1] WHEN raw_col = 'quantity' THEN 'quantity' END AS direct FROM j),
k AS (SELECT *, direct IS NULL AND (list_contains(h, 'equip_type') OR {_NAMES}) AS cand FROM d),
w AS (SELECT *, bool_or(coalesce(direct = 'equip_type', false)) OVER t AS has_type, min(CASE WHEN cand THEN ord END) OVER t AS first_c,
  count(*) FILTER (direct = 'other_names') OVER t AS n_o, count(*) FILTER (direct = 'variant') OVER t AS n_v FROM k WINDOW t AS (PARTITION BY meta_id))
SELECT meta_id::VARCHAR AS table_name, raw_col, ord, CASE WHEN NOT has_type AND (cand AND ord = first_c
   OR first_c IS NULL AND n_o = 1 AND direct = 'other_names' OR first_c IS NULL AND n_o <> 1 AND n_v = 1 AND direct = 'variant')
  THEN 'equip_type' ELSE coalesce(direct, 'note') END AS super_col FROM w""")
def column_classes(spark: SparkSession, d: str) -> DataFrame:
    """Column rules learned from all mapped scrapes, applied to all columns."""
    cols = read_table(spark, d, "a_meta_table_of_columns").select(
        F.col("meta_id").cast("string").alias("table_name"), F.lower(F.trim("column_name")).alias("column_name"), "pos"
    )
    return mapping.classify_columns(cols, _mapping(spark, d).select(F.col("raw_col").alias("text"), "super_col").distinct())


#: The same query under the name it had while another one learned from a third of the mappings.
QUERIES["column_classes_all"], ORACLES["column_classes_all"] = column_classes, ORACLES["column_classes"]


def _master_sql() -> str:
    meta_of = {"country": "country", "class_path": "class_path", "sub_class": "equipment_class"}
    cols = []
    for c in CANONICAL_COLUMNS:
        n = f"count(*) FILTER (super_col = '{c}')"
        raw = f"CASE WHEN bool_or(super_col = '{c}' AND value IS NULL) THEN NULL ELSE string_agg(value, '; ' ORDER BY ord) FILTER (super_col = '{c}') END"
        if c in meta_of:
            m = f"any_value({meta_of[c]})" if c != "class_path" else "NULL::VARCHAR"
            cols.append(f"CASE WHEN {n} = 0 THEN {m} WHEN {m} IS NULL THEN {raw} ELSE {m} || '; ' || {raw} END AS {c}")
        else:
            cols.append(f"CASE WHEN {n} > 0 THEN {raw} END AS {c}")
    return f"""WITH l AS (SELECT meta_id, super_col, raw_col, ord FROM ({_LONG})),
cells AS (SELECT meta_id, row_idx, lower(trim(replace(c.name, '_', ' '))) AS raw_col, c.value AS value FROM (SELECT meta_id, row_idx, unnest(cells) AS c FROM raw_rows)),
j AS (SELECT cells.*, l.super_col, l.ord, m.country, m.equipment_class FROM cells LEFT JOIN l USING (meta_id, raw_col) LEFT JOIN a_mapping_table m USING (meta_id))
SELECT meta_id::VARCHAR AS table_name, row_idx, {", ".join(cols)} FROM j GROUP BY 1, 2"""


@query(_master_sql())
def master_rows(spark: SparkSession, d: str) -> DataFrame:
    """The sample rows of all scrapes under the canonical columns."""
    rows = _rows(spark, d).withColumn(
        "cells",
        F.transform("cells", lambda c: F.struct(c["pos"].alias("pos"), F.lower(F.trim(F.translate(c["name"], "_", " "))).alias("name"), c["value"].alias("value"))),
    )
    t = read_table(spark, d, "a_mapping_table")
    heads = t.select(F.col("meta_id").cast("string").alias("table_name"), F.lit("").alias("url"), "country", F.lit(None).cast("string").alias("class_path"), F.col("equipment_class").alias("sub_class"))
    return mapping.build_master(rows, _mapping(spark, d), heads).drop("url")


def _repair_sql() -> str:
    """Contestants of each class cell, their rule hits, and what becomes of the row; the test tables know no mission classes."""
    single = r"regexp_replace(regexp_replace(trim({0}), '([^s])s$', '\1'), '^s$', '')"
    spoken = ", ".join({"sub_class": "final", "class_path": "coalesce(won, class_path)"}.get(c, c) for c in CANONICAL_COLUMNS if c != "note")
    rules = _RULE_SQL.partition(",\ntexts AS")[0]
    return f"""WITH {rules},
parts AS (SELECT row_id, list_filter(list_transform(string_split(sub_class, ';'), lambda v: {single.format("v")}), lambda v: v <> '') AS xs FROM a_master_equipment WHERE sub_class IS NOT NULL),
asked AS (SELECT row_id, unnest(xs) AS x, generate_subscripts(xs, 1) AS i FROM parts),
hits AS (SELECT x, entity, path FROM (SELECT DISTINCT x FROM asked) JOIN rules ON regexp_matches(lower(x), pattern) JOIN taxonomy_nodes ON name = entity),
put AS (SELECT a.row_id, a.i, a.x, h.entity, h.path FROM asked a LEFT JOIN hits h USING (x)),
firsts AS (SELECT row_id, entity, min(i) AS i FROM put WHERE entity IS NOT NULL GROUP BY 1, 2),
names AS (SELECT row_id, list(entity ORDER BY i, entity) AS names FROM firsts GROUP BY 1),
shared AS (SELECT row_id, k, min(path[1:k]) AS head, count(DISTINCT path[1:k]) = 1 AND min(len(path)) >= k AS good FROM put, range(1, 12) t(k) WHERE entity IS NOT NULL GROUP BY 1, 2),
nearest AS (SELECT row_id, max_by(head, k) AS head FROM shared WHERE good GROUP BY 1),
told AS (SELECT row_id, list(DISTINCT x) AS noted, list_sort(list(DISTINCT x) FILTER (entity IS NULL)) AS unknown FROM put GROUP BY 1),
best AS (SELECT t.*, coalesce(names, []) AS names, CASE WHEN len(names) = 1 THEN names[1] ELSE head[-1] END AS final,
  CASE WHEN len(names) = 1 THEN (SELECT array_to_string(path, '>') FROM taxonomy_nodes WHERE name = names[1]) ELSE array_to_string(head, '>') END AS won
  FROM told t LEFT JOIN names USING (row_id) LEFT JOIN nearest USING (row_id)),
full_ AS (SELECT m.*, b.noted, b.unknown, b.names, b.final, b.won, b.row_id IS NOT NULL AS known FROM a_master_equipment m LEFT JOIN best b ON m.row_id = b.row_id),
noted AS (SELECT *, list_sort(list_filter(list_distinct(list_concat(noted, list_filter(names, lambda n: n IS DISTINCT FROM final))), lambda n: NOT list_contains(list_filter([{spoken}], lambda v: v IS NOT NULL), n))) AS notes FROM full_)
SELECT row_id, CASE WHEN known THEN final ELSE sub_class END AS sub_class, coalesce(won, class_path) AS class_path,
  CASE WHEN known AND len(notes) > 0 THEN array_to_string(notes, '; ') ELSE note END AS note, coalesce(array_to_string(unknown, '; '), '') AS unknown FROM noted"""


@query(_repair_sql())
def repaired_classes(spark: SparkSession, d: str) -> DataFrame:
    nodes = read_table(spark, d, "taxonomy_nodes")
    rows = read_table(spark, d, "a_master_equipment").select("row_id", *CANONICAL_COLUMNS)
    fixed = refine.fix_classes(rows, taxonomy.name_rules(nodes), taxonomy.paths(nodes), CANONICAL_COLUMNS, equipment=ROOT)
    return fixed.select("row_id", "sub_class", "class_path", "note", F.array_join("unknown", "; ").alias("unknown"))


@query("SELECT node_id, array_to_string(path, '; ') AS path FROM taxonomy_nodes")
def list_collapse(spark: SparkSession, d: str) -> DataFrame:
    return refine.collapse_lists(read_table(spark, d, "taxonomy_nodes").select("node_id", "path"), ["path"])


@query("SELECT row_id, country || '; ' || origin || '; ' || status AS joined FROM a_canonical_equipment")
def null_propagating_concat(spark: SparkSession, d: str) -> DataFrame:
    sep = F.lit("; ")
    return read_table(spark, d, "a_canonical_equipment").select("row_id", F.concat("country", sep, "origin", sep, "status").alias("joined"))


# --- HTML ---------------------------------------------------------------------------------------------------------


def _escape(c):
    for sign, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(sign), F.lit(entity))
    return c


def _pages(spark: SparkSession, d: str) -> DataFrame:
    """Each scrape's sample rows as a page: headings, one table with a caption row above its header, and a junk table."""
    meta = read_table(spark, d, "a_meta_table").select("meta_id", "country", "url", *classification.HEADINGS)
    rows = read_table(spark, d, "raw_rows")
    head = lambda tag, h: F.coalesce(F.concat(F.lit(f"<{tag}>"), _escape(F.col(h)), F.lit(f"</{tag}>")), F.lit(""))
    line = lambda tag, part: F.concat(F.lit("<tr>"), F.array_join(F.transform("cells", lambda c: F.concat(F.lit(f"<{tag}>"), F.coalesce(_escape(c[part]), F.lit("")))), ""), F.lit("</tr>"))
    lines = rows.select("meta_id", "row_idx", line("td", "value").alias("body"), line("th", "name").alias("head"), F.size("cells").alias("n"))
    tables = lines.groupBy("meta_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row_idx", "body"))), lambda r: r["body"]), "").alias("body"),
        F.min_by("head", "row_idx").alias("head"), F.max("n").alias("n"),
    )
    caption = F.concat(F.lit("<tr><th colspan='"), F.col("n").cast("string"), F.lit("\"'>caption</tr>"))
    table = F.concat(F.lit("<table class='wikitable'>"), caption, "head", "body", F.lit("</table>"))
    junk = F.lit("<h2>See also</h2><table><tr><th>a<th>b<tr><td>1<td>2</table>")
    page = F.concat(head("h2", "section_h2"), head("h3", "section_h3"), head("h4", "section_h4"), table, junk)
    return meta.join(tables, "meta_id").select(F.col("meta_id").alias("page_id"), "country", "url", page.alias("html")).repartition(F.col("page_id"))


_FLAT = r"trim(regexp_replace({0}, '[\s\x{{00A0}}\x{{2009}}\x{{202F}}\p{{Z}}]+', ' ', 'g'))"


@query(f"""
WITH keep AS (SELECT meta_id FROM a_meta_table WHERE NOT regexp_matches(lower(coalesce(nullif(concat_ws('_', nullif(section_h2, ''), nullif(section_h3, ''), nullif(section_h4, '')), ''), 'untitled')),
  'external links|references|reference|contents|see also|bibliography|sources|further reading|notes|silhouettes')),
c AS (SELECT meta_id, row_idx, unnest(cells) AS c FROM raw_rows),
r AS (SELECT meta_id, (row_number() OVER (PARTITION BY meta_id ORDER BY row_idx))::INT AS k, row_idx FROM raw_rows)
SELECT meta_id AS page_id, k AS row_idx, c.pos AS pos, {_FLAT.format("c.name")} AS name, nullif({_FLAT.format("c.value")}, '') AS value
FROM c JOIN r USING (meta_id, row_idx) JOIN keep USING (meta_id)
UNION ALL SELECT meta_id, 0, pos, name, 'caption' FROM (SELECT DISTINCT meta_id, c.pos AS pos, {_FLAT.format("c.name")} AS name FROM c JOIN keep USING (meta_id))""")
def html_tables(spark: SparkSession, d: str) -> DataFrame:
    """Pages built from the sample rows and read again: junk is gone, the header is found below the caption."""
    found = html.wanted_tables(html.extract_tables(_pages(spark, d), clean=False))
    return found.select("page_id", "row_idx", F.inline("cells")).select("page_id", "row_idx", "pos", "name", "value")


#: Page text: composed, without reference marks, with single spaces.
_HEAD = _FLAT.format(r"regexp_replace(nfc_normalize(" + _WIDE.replace("{0}", "PART") + r"), '\[[0-9a-zA-Z ]{1,10}\]', '', 'g')")


@query(f"""
WITH m AS (SELECT m.meta_id, {_HEAD.replace("PART", "section_h2")} AS h2, {_HEAD.replace("PART", "section_h3")} AS h3, {_HEAD.replace("PART", "section_h4")} AS h4
  FROM a_meta_table m WHERE meta_id IN (SELECT meta_id FROM raw_rows))
SELECT meta_id AS page_id, 0 AS table_no, h2, h3, h4, ['wikitable'] AS classes, 'caption' AS first_text FROM m
UNION ALL SELECT meta_id, 1, 'See also', NULL, NULL, []::VARCHAR[], 'a' FROM m""")
def html_headings(spark: SparkSession, d: str) -> DataFrame:
    found = html.extract_tables(_pages(spark, d))
    return found.select("page_id", "table_no", "h2", "h3", "h4", "classes", "first_text").distinct()


@query("""
SELECT country, trim(section_title) AS page_title, 'https://lists.armoury.example/wiki/' || meta_id AS url, count(*) AS n FROM a_meta_table
WHERE meta_id % 5 <> 0 GROUP BY 1, 2, 3""")
def html_links(spark: SparkSession, d: str) -> DataFrame:
    """A list page per country with inner, absolute and outer links."""
    meta = read_table(spark, d, "a_meta_table")
    host = F.when(F.col("meta_id") % 2 == 0, "https://lists.armoury.example").otherwise("")
    href = F.when(F.col("meta_id") % 5 == 0, F.lit("https://elsewhere.example/wiki/x")).otherwise(F.concat(host, F.lit("/wiki/"), F.col("meta_id").cast("string")))
    item = F.concat(F.lit('<li>see <a href="'), href, F.lit('">'), _escape(F.col("section_title")), F.lit("</a> and <a href='/wiki/other'>more</a>"))
    # a page lists the scrapes of one country within a range of 500 ids, however many there are
    lists = meta.groupBy("country", F.floor(F.col("meta_id") / 500).alias("part")).agg(F.array_join(F.collect_list(item), "").alias("items"))
    pages = lists.select(F.concat(F.lit("<section><h2> "), _escape(F.col("country")), F.lit(" </h2><ul>"), "items", F.lit("</ul></section>")).alias("html"))
    links = html.extract_links(pages, "https://lists.armoury.example")
    return links.groupBy("country", "page_title", "url").agg(F.count(F.lit(1)).alias("n"))


# --- older groupings ----------------------------------------------------------------------------------------------


@query("""
WITH c AS (SELECT meta_id, list_distinct(list(lower(trim(column_name)))) AS cols FROM a_meta_table_of_columns GROUP BY 1),
m AS (SELECT meta_id, table_name, lag(meta_id) OVER (PARTITION BY table_name ORDER BY meta_id) AS prev FROM a_meta_table)
SELECT m.meta_id, round(CASE WHEN len(list_distinct(list_concat(a.cols, b.cols))) > 0 THEN len(list_intersect(a.cols, b.cols)) / len(list_distinct(list_concat(a.cols, b.cols))) ELSE 0 END, 9) AS similarity
FROM m JOIN c a USING (meta_id) JOIN c b ON m.prev = b.meta_id""")
def jaccard_of_columns(spark: SparkSession, d: str) -> DataFrame:
    """How alike the columns of a delivery and the one before are."""
    from pyspark.sql import Window as W

    sets = read_table(spark, d, "a_meta_table_of_columns").groupBy("meta_id").agg(F.collect_set(F.lower(F.trim("column_name"))).alias("cols"))
    prev = F.lag("meta_id").over(W.partitionBy("table_name").orderBy("meta_id"))
    pairs = read_table(spark, d, "a_meta_table").select("meta_id", prev.alias("prev"))
    joined = pairs.join(sets, "meta_id").join(sets.select(F.col("meta_id").alias("prev"), F.col("cols").alias("before")), "prev")
    return joined.select("meta_id", F.round(legacy.jaccard(F.col("cols"), F.col("before")), 9).alias("similarity"))


@query("""
WITH n AS (SELECT country, equipment_class AS label, count(*) AS k FROM a_mapping_table GROUP BY 1, 2), s AS (SELECT country, sum(k)::BIGINT AS size FROM n GROUP BY 1)
SELECT country, arg_min(label, (-CASE WHEN label IS NULL THEN 0 ELSE k END, label)) AS label, max(CASE WHEN label IS NULL THEN 0 ELSE k END) / any_value(size) AS strength, any_value(size) AS size
FROM n JOIN s USING (country) GROUP BY 1""")
def label_and_strength(spark: SparkSession, d: str) -> DataFrame:
    return legacy.label_and_strength(read_table(spark, d, "a_mapping_table"), "country", "equipment_class")


@query("""
SELECT meta_id, CASE WHEN regexp_matches(lower(section_title), 'missile') THEN 'missiles' WHEN regexp_matches(lower(section_title), 'boat|ship') THEN 'sea' END AS domain,
  CASE WHEN regexp_matches(lower(section_title), 'light') THEN 'light' END AS weight FROM a_meta_table WHERE NOT regexp_matches(lower(coalesce(section_title, '')), 'gallery')""")
def classify_titles(spark: SparkSession, d: str) -> DataFrame:
    rules = spark.createDataFrame(
        [(1, "sea", "domain", "boat|ship"), (2, "missiles", "domain", "missile"), (3, "light", "weight", "light"), (4, "", "ignore", "gallery")],
        "pos int, category string, type string, pattern string",
    )
    return legacy.classify_titles(read_table(spark, d, "a_meta_table"), rules, key="meta_id")


@query(f"SELECT meta_id::VARCHAR AS table_name, raw_col, super_col FROM ({_LONG})")
def recategorised(spark: SparkSession, d: str) -> DataFrame:
    lists = _mapping(spark, d).groupBy("table_name", "super_col").agg(F.collect_list("raw_col").alias("raws"))
    nested = lists.groupBy("table_name").agg(F.map_from_entries(F.collect_list(F.struct("super_col", "raws"))).alias("mapping"))
    return legacy.recategorise(nested)
