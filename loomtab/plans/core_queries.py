"""The p2, p3, p4 and p5 queries, over whole tables with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtab.operators import drift, measures, packed, snapshots
from loomtab.schemas import MAPPED_FIELDS
from loomtab.session import read_table

PACKED_FIELDS = ("origin", "other_names", "dates")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    sizes = measures.harmonise_measures(read_table(spark, d, "a_master_equipment"), read_table(spark, d, "a_mapping_table"))
    return sizes.select("row_id", "field_name", "value_milli")


def p2_units(spark: SparkSession, d: str) -> DataFrame:
    """How many sizes of each field were stated in each unit, and their range in the common unit."""
    sizes = measures.harmonise_measures(read_table(spark, d, "a_master_equipment"), read_table(spark, d, "a_mapping_table"))
    return sizes.groupBy("field_name", "unit").agg(
        F.count(F.lit(1)).alias("n"), F.min("value_milli").alias("least_milli"), F.max("value_milli").alias("most_milli")
    )


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    changes = snapshots.snapshot_changes(read_table(spark, d, "a_canonical_equipment"), read_table(spark, d, "a_meta_table"))
    return changes.select("meta_id", "item_no", "change_kind")


def p3_fields(spark: SparkSession, d: str) -> DataFrame:
    """Changes over several fields at once, counted by kind and by the fields that differ."""
    changes = snapshots.snapshot_changes(
        read_table(spark, d, "a_canonical_equipment"), read_table(spark, d, "a_meta_table"), fields=("quantity_clean", "status", "role")
    )
    return changes.groupBy("change_kind", F.array_join("changed_fields", ",").alias("fields")).agg(F.count(F.lit(1)).alias("n"))


def p4_all(spark: SparkSession, d: str) -> DataFrame:
    rows = read_table(spark, d, "a_master_equipment")
    countries = rows.select("country").union(read_table(spark, d, "a_meta_table").select("country"))
    return packed.split_packed(rows, PACKED_FIELDS, packed.names_with_delimiters(countries))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return p4_all(spark, d).where("n_items >= 2").select("row_id", "field_name", "item_pos", "item_value")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return _steps(spark, d).select("meta_id", "change_kind", "old_name", "new_name")


def _steps(spark: SparkSession, d: str) -> DataFrame:
    return drift.migration_steps(*(read_table(spark, d, t) for t in ("a_meta_table_of_columns", "a_mapping_table", "a_meta_table")))


def p5_versions(spark: SparkSession, d: str) -> DataFrame:
    return drift.schema_versions(*(read_table(spark, d, t) for t in ("a_meta_table_of_columns", "a_mapping_table", "a_meta_table")))


def p5_rows(spark: SparkSession, d: str) -> DataFrame:
    """All sample rows under one schema for each table; casts are tested apart, as SQL dialects cast differently."""
    return _consistent(spark, d).drop("value_cast")


def _consistent(spark: SparkSession, d: str) -> DataFrame:
    return drift.consistent_rows(
        *(read_table(spark, d, t) for t in ("raw_rows", "a_meta_table_of_columns", "a_mapping_table", "a_meta_table"))
    )


QUERIES = {f.__name__: f for f in (p2_found, p2_units, p3_found, p3_fields, p4_found, p4_all, p5_found, p5_versions, p5_rows)}

_SNAPS = """snaps AS (
  SELECT table_name, scrape_timestamp AS at, min(meta_id) AS sid,
         lag(min(meta_id)) OVER (PARTITION BY table_name ORDER BY scrape_timestamp) AS pid
  FROM a_meta_table GROUP BY 1, 2),
ids AS (SELECT m.meta_id, s.sid FROM a_meta_table m JOIN snaps s ON m.table_name = s.table_name AND m.scrape_timestamp = s.at)"""


def _changes_sql(fields: tuple[str, ...]) -> str:
    struct = ", ".join(f"{f} := {f}" for f in fields)
    differ = ", ".join(f"CASE WHEN a.r.{f} IS DISTINCT FROM b.r.{f} THEN '{f}' END" for f in sorted(fields))
    return f"""WITH {_SNAPS},
items AS (SELECT i.sid, c.item_no, max_by(struct_pack({struct}), c.row_id) AS r
          FROM a_canonical_equipment c JOIN ids i USING (meta_id) GROUP BY 1, 2),
news AS (SELECT s.sid AS meta_id, i.item_no, i.r FROM items i JOIN snaps s USING (sid) WHERE s.pid IS NOT NULL),
olds AS (SELECT s.sid AS meta_id, i.item_no, i.r FROM items i JOIN snaps s ON i.sid = s.pid),
both_ AS (SELECT meta_id, item_no,
   CASE WHEN b.item_no IS NULL THEN 'removed' WHEN a.item_no IS NULL THEN 'added' ELSE 'changed' END AS change_kind,
   CASE WHEN a.item_no IS NULL OR b.item_no IS NULL THEN '' ELSE concat_ws(',', {differ}) END AS fields
   FROM olds a FULL JOIN news b USING (meta_id, item_no))
"""


_KEY = r"trim(regexp_replace(lower({c}), '[_\s\x{{00A0}}\p{{Z}}]+', ' ', 'g'))"
_FAMILY = """CASE WHEN regexp_matches(lower({c}), '^(big)?int') THEN 'whole number'
  WHEN regexp_matches(lower({c}), '^(float|real|double)') THEN 'real number'
  WHEN regexp_matches(lower({c}), '^(date|time)') THEN 'date or time'
  WHEN {c} IS NOT NULL THEN 'text' END"""


def _feeds() -> str:
    return " UNION ALL ".join(
        f"SELECT meta_id, {i} AS rank, '{f}' AS field, unnest(string_split({f}, ',')) AS c FROM a_mapping_table" for i, f in enumerate(MAPPED_FIELDS)
    )


def _drift_sql() -> str:
    key = _KEY.format(c="c")
    return f"""WITH {_SNAPS},
feeds AS (SELECT i.sid, {key} AS name, min_by(field, rank) AS field FROM ({_feeds()}) JOIN ids i USING (meta_id) GROUP BY 1, 2),
cols AS (SELECT sid, name, min_by(family, meta_id) FILTER (family IS NOT NULL) AS family FROM (
   SELECT i.sid, meta_id, {_KEY.format(c='column_name')} AS name, {_FAMILY.format(c='value_type')} AS family
   FROM a_meta_table_of_columns JOIN ids i USING (meta_id)) WHERE name <> '' GROUP BY 1, 2),
full_ AS (SELECT c.*, f.field FROM cols c LEFT JOIN feeds f USING (sid, name)),
news AS (SELECT s.sid AS meta_id, c.name, c.family, c.field FROM full_ c JOIN snaps s USING (sid) WHERE s.pid IS NOT NULL),
olds AS (SELECT s.sid AS meta_id, c.name, c.family, c.field FROM full_ c JOIN snaps s ON c.sid = s.pid),
gone AS (SELECT * FROM olds o WHERE NOT EXISTS (SELECT 1 FROM news n WHERE n.meta_id = o.meta_id AND n.name = o.name)),
came AS (SELECT * FROM news n WHERE NOT EXISTS (SELECT 1 FROM olds o WHERE n.meta_id = o.meta_id AND n.name = o.name)),
g1 AS (SELECT meta_id, field, min(name) AS name, min(family) AS family FROM gone WHERE field IS NOT NULL GROUP BY 1, 2 HAVING count(*) = 1),
c1 AS (SELECT meta_id, field, min(name) AS name, min(family) AS family FROM came WHERE field IS NOT NULL GROUP BY 1, 2 HAVING count(*) = 1),
ren AS (SELECT meta_id, g1.name AS old_name, c1.name AS new_name, g1.family AS f1, c1.family AS f2 FROM g1 JOIN c1 USING (meta_id, field)),
stay AS (SELECT o.meta_id, o.name AS old_name, n.name AS new_name, o.family AS f1, n.family AS f2 FROM olds o JOIN news n USING (meta_id, name))
SELECT meta_id, 'renamed' AS change_kind, old_name, new_name FROM ren
UNION ALL SELECT meta_id, 'retyped', old_name, new_name FROM (SELECT * FROM ren UNION ALL SELECT * FROM stay) WHERE f1 <> f2
UNION ALL SELECT meta_id, 'removed', name, '' FROM gone g WHERE NOT EXISTS (SELECT 1 FROM ren r WHERE r.meta_id = g.meta_id AND r.old_name = g.name)
UNION ALL SELECT meta_id, 'added', '', name FROM came g WHERE NOT EXISTS (SELECT 1 FROM ren r WHERE r.meta_id = g.meta_id AND r.new_name = g.name)"""


def _versions_sql() -> str:
    return f"""WITH {_SNAPS},
feeds AS (SELECT i.sid, {_KEY.format(c="c")} AS name, min_by(field, rank) AS field FROM ({_feeds()}) JOIN ids i USING (meta_id) GROUP BY 1, 2),
cols AS (SELECT sid, name, min_by(family, meta_id) FILTER (family IS NOT NULL) AS family FROM (
   SELECT i.sid, meta_id, {_KEY.format(c='column_name')} AS name, {_FAMILY.format(c='value_type')} AS family
   FROM a_meta_table_of_columns JOIN ids i USING (meta_id)) WHERE name <> '' GROUP BY 1, 2),
prints AS (SELECT sid, count(*) AS n, sha256(array_to_string(list(name || chr(1) || coalesce(family, '?') || chr(1) || coalesce(field, '') ORDER BY name), chr(2))) AS p
   FROM cols LEFT JOIN feeds USING (sid, name) GROUP BY 1),
full_ AS (SELECT s.*, coalesce(p, sha256('')) AS fingerprint, coalesce(n, 0) AS n_columns FROM snaps s LEFT JOIN prints USING (sid))
SELECT a.sid AS meta_id, a.table_name, a.at, a.fingerprint, a.n_columns, a.fingerprint IS DISTINCT FROM b.fingerprint AS is_new_version
FROM full_ a LEFT JOIN full_ b ON a.pid = b.sid"""


def _rows_sql() -> str:
    """Events of each column name in time; a rename hands on to the next event of the name it gives."""
    key = _KEY.format(c="c.name")
    return f"""WITH RECURSIVE steps AS ({_drift_sql()}),
{_SNAPS},
ev AS (SELECT s.table_name, s.at AS since, p.old_name AS name, p.change_kind AS kind, p.new_name AS to_name
  FROM steps p JOIN snaps s ON s.sid = p.meta_id WHERE change_kind IN ('renamed', 'removed')),
walk AS (SELECT table_name, since, name, to_name AS at_name, since AS at_since, NULL::TIMESTAMP AS until, true AS open FROM ev WHERE kind = 'renamed'
  UNION ALL
  SELECT w.table_name, w.since, w.name, CASE WHEN n.kind = 'renamed' THEN n.to_name ELSE w.at_name END, n.since, CASE WHEN n.kind = 'removed' THEN n.since END, n.kind = 'renamed'
  FROM walk w JOIN ev n ON n.table_name = w.table_name AND n.name = w.at_name AND n.since > w.at_since
  WHERE w.open AND NOT EXISTS (SELECT 1 FROM ev m WHERE m.table_name = n.table_name AND m.name = n.name AND m.since > w.at_since AND m.since < n.since)),
ends AS (SELECT table_name, since, name, arg_max(at_name, at_since) AS final_name, max(until) AS until, true AS renamed FROM walk GROUP BY 1, 2, 3
  UNION ALL SELECT table_name, since, name, name, since, false FROM ev WHERE kind = 'removed'),
cols AS (SELECT sid, name, min_by(family, meta_id) FILTER (family IS NOT NULL) AS family FROM (
   SELECT i.sid, meta_id, {_KEY.format(c='column_name')} AS name, {_FAMILY.format(c='value_type')} AS family
   FROM a_meta_table_of_columns JOIN ids i USING (meta_id)) WHERE name <> '' GROUP BY 1, 2),
known AS (SELECT c.*, s.table_name, s.at FROM cols c JOIN snaps s USING (sid)),
route AS (SELECT k.sid, k.table_name, k.at, k.name, k.family,
  coalesce(arg_min(e.final_name, e.since) FILTER (e.renamed AND e.since > k.at), k.name) AS final_name,
  coalesce(arg_min(e.final_name, e.since) FILTER (e.since > k.at), k.name) AS own_name,
  (min(struct_pack(s := e.since, u := e.until)) FILTER (e.since > k.at)).u AS until
  FROM known k LEFT JOIN ends e ON e.table_name = k.table_name AND e.name = k.name GROUP BY 1, 2, 3, 4, 5),
clash AS (SELECT *, count(*) OVER (PARTITION BY sid, final_name) > 1 AS clash FROM route),
named AS (SELECT * REPLACE (CASE WHEN until IS NOT NULL AND bool_or(clash) OVER (PARTITION BY table_name, own_name, until)
  THEN own_name || ' (until ' || until || ')' ELSE final_name END AS final_name) FROM clash),
finals AS (SELECT table_name, final_name, max_by(family, named.at) FILTER (family IS NOT NULL) AS family FROM named GROUP BY 1, 2),
cells AS (SELECT r.meta_id, r.table_name, r.row_idx, c.value AS value, k, {key} AS name FROM (SELECT meta_id, table_name, row_idx, unnest(cells) AS c, generate_subscripts(cells, 1) AS k FROM raw_rows) r),
put AS (SELECT c.meta_id, c.table_name, c.row_idx, c.value, c.k, coalesce(n.final_name, c.name) AS column_name
  FROM cells c LEFT JOIN ids i USING (meta_id) LEFT JOIN named n ON n.sid = i.sid AND n.name = c.name WHERE c.name <> ''),
every AS (SELECT r.meta_id, r.table_name, r.row_idx, f.final_name AS column_name FROM raw_rows r JOIN finals f USING (table_name)
  UNION SELECT meta_id, table_name, row_idx, column_name FROM put)
SELECT r.meta_id, r.table_name, r.row_idx, r.column_name, (row_number() OVER (PARTITION BY r.meta_id, r.table_name, r.row_idx, r.column_name ORDER BY p.k))::INT AS value_no, f.family, p.value
FROM every r LEFT JOIN put p USING (meta_id, table_name, row_idx, column_name) LEFT JOIN finals f ON f.table_name = r.table_name AND f.final_name = r.column_name"""


ORACLES = {
    "p3_found": _changes_sql(("quantity_clean",)) + "SELECT meta_id, item_no, change_kind FROM both_ WHERE change_kind <> 'changed' OR fields <> ''",
    "p3_fields": _changes_sql(("quantity_clean", "status", "role"))
    + "SELECT change_kind, fields, count(*) AS n FROM both_ WHERE change_kind <> 'changed' OR fields <> '' GROUP BY 1, 2",
    "p5_found": _drift_sql(),
    "p5_versions": _versions_sql(),
    "p5_rows": _rows_sql(),
}
