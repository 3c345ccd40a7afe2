"""Queries over readers, sinks, the catalogue and lookups, each with its SQL oracle where SQL can say the same."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtab.functions import text as X
from loomtab.operators import classification, legacy, mapping, summary, taxonomy
from loomtab.plans.reference_queries import ORACLES as REFERENCE
from loomtab.plans.reference_queries import _RULE_SQL, ROOT, _classified, _features, _LONG, _mapping
from loomtab.session import cut_lineage, read_table, shared_folder
from loomtab.sources import files, sinks

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def _scratch(spark: SparkSession) -> str:
    """A new path in the shared folder, for queries that write and read again."""
    return os.path.join(shared_folder(spark), f"written-{uuid.uuid4().hex}")


# --- readers and sinks --------------------------------------------------------------------------------------------

_NOTE = "coalesce(section_h2, '') || chr(10) || '\"' || country || '\", x'"


@query(f"SELECT meta_id::VARCHAR AS meta_id, {_NOTE} AS note FROM a_meta_table")
def csv_records(spark: SparkSession, d: str) -> DataFrame:
    """Records with commas, quotes and line breaks, written as CSV and read again as maps."""
    note = F.concat(F.coalesce("section_h2", F.lit("")), F.lit('\n"'), "country", F.lit('", x'))
    path = _scratch(spark)
    read_table(spark, d, "a_meta_table").select("meta_id", note.alias("note")).write.csv(
        path, header=True, escape='"', quoteAll=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )
    good, _ = files.checked_records(spark, path)
    return good.select(F.col("fields")["meta_id"].alias("meta_id"), F.col("fields")["note"].alias("note"))


@query("SELECT meta_id::VARCHAR AS meta_id, table_name FROM a_meta_table WHERE meta_id % 7 <> 0")
def csv_arrays(spark: SparkSession, d: str) -> DataFrame:
    """Lists of a checked width; every seventh record has a field too many and is set aside."""
    return _uneven(spark, d)[0].select(F.get("fields", F.lit(0)).alias("meta_id"), F.get("fields", F.lit(1)).alias("table_name"))


@query("SELECT meta_id || ',' || table_name || ',x' AS line FROM a_meta_table WHERE meta_id % 7 = 0")
def csv_rejected(spark: SparkSession, d: str) -> DataFrame:
    return _uneven(spark, d)[1]


def _uneven(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    line = F.concat_ws(",", F.col("meta_id").cast("string"), "table_name", F.when(F.col("meta_id") % 7 == 0, F.lit("x")))
    path = _scratch(spark)
    rows = read_table(spark, d, "a_meta_table").select(line.alias("value"), F.spark_partition_id().alias("part"))
    heads = rows.select("part").distinct().select(F.lit("meta_id,table_name").alias("value"), "part", F.lit(0).alias("body"))
    every = heads.unionByName(rows.withColumn("body", F.lit(1))).repartition("part").sortWithinPartitions("part", "body")
    # each part's header comes first in its own file
    every.select("value", "part").write.partitionBy("part").text(path)
    return files.checked_arrays(spark, os.path.join(path, "*"))


@query("SELECT n_name AS value FROM nation")
def raw_lines(spark: SparkSession, d: str) -> DataFrame:
    path = _scratch(spark)
    read_table(spark, d, "nation").select("n_name").write.text(path)
    return files.lines(spark, path)


@query("SELECT country, trim(section_title) AS page_title, url FROM a_meta_table WHERE url IS NOT NULL AND section_title NOT LIKE '%\"%'")
def curated_links(spark: SparkSession, d: str) -> DataFrame:
    """An edge list whose header and values carry spaces after the commas."""
    path = _scratch(spark)
    rows = read_table(spark, d, "a_meta_table").where("url IS NOT NULL AND section_title NOT LIKE '%\"%'")
    out = rows.select(F.col("country").alias("country_name"), F.concat(F.lit(" "), F.col("section_title")).alias(" page_title"), F.concat(F.lit(" "), F.col("url")).alias(" url"))
    out.write.csv(path, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return files.curated_links(spark, path)


@query("SELECT meta_id, array_to_string(list(column_name ORDER BY pos), '|') AS names FROM a_meta_table_of_columns GROUP BY 1")
def listed_by_key(spark: SparkSession, d: str) -> DataFrame:
    lists = files.key_lists(read_table(spark, d, "a_meta_table_of_columns"), "meta_id", "column_name", "pos")
    return lists.select("meta_id", F.array_join("column_name", "|").alias("names"))


@query("SELECT meta_id, arg_max(column_name, pos) AS column_name FROM a_meta_table_of_columns GROUP BY 1")
def last_by_key(spark: SparkSession, d: str) -> DataFrame:
    return files.key_values(read_table(spark, d, "a_meta_table_of_columns"), "meta_id", "column_name", "pos")


@query("SELECT DISTINCT value_type FROM a_meta_table_of_columns")
def value_set(spark: SparkSession, d: str) -> DataFrame:
    return files.first_column_set(read_table(spark, d, "a_meta_table_of_columns"), "value_type")


@query("SELECT * FROM taxonomy_nodes")
def promoted_copy(spark: SparkSession, d: str) -> DataFrame:
    """A snapshot written, promoted to the next stage whole, and read."""
    path = _scratch(spark) + "-RAW"
    after = sinks.promote(spark, sinks.write_table(read_table(spark, d, "taxonomy_nodes"), path), sinks.next_stage(path))
    return spark.read.parquet(after)


@query(REFERENCE["summary_by_key"])
def exported_summary(spark: SparkSession, d: str) -> DataFrame:
    """The summary as people get it: one CSV file, read again."""
    path = sinks.export_csv(summary.summarise(read_table(spark, d, "a_canonical_equipment"), hidden=ROOT), _scratch(spark))
    return spark.read.csv(path, header=True, schema="country string, class_path string, sub_class string, total_quantity bigint", multiLine=True, escape='"')


# --- catalogue and lookups ----------------------------------------------------------------------------------------


@query("""
WITH n AS (SELECT DISTINCT table_name FROM a_meta_table WHERE NOT starts_with(table_name, 'a_')),
r AS (SELECT table_name, count(*) AS k FROM raw_rows GROUP BY 1), c AS (SELECT table_name, count(*) AS k FROM a_meta_table_of_columns GROUP BY 1)
SELECT n.table_name, CASE WHEN instr(n.table_name, '_table_') > 0 THEN substr(n.table_name, 1, instr(n.table_name, '_table_') - 1) ELSE '' END AS country,
  coalesce(r.k, 0) AS row_count, coalesce(c.k, 0) AS column_count, NULL::VARCHAR AS category_guess FROM n LEFT JOIN r USING (table_name) LEFT JOIN c USING (table_name)""")
def catalogue_seed(spark: SparkSession, d: str) -> DataFrame:
    names = read_table(spark, d, "a_meta_table").select(F.col("table_name").alias("name"))
    return files.catalogue(names, read_table(spark, d, "raw_rows"), read_table(spark, d, "a_meta_table_of_columns"))


@query("SELECT DISTINCT lower(country) AS country FROM a_meta_table WHERE table_name = (SELECT min(table_name) FROM a_meta_table)")
def country_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Point lookup of one table's country."""
    tables = read_table(spark, d, "a_meta_table")
    return files.country_of_table(tables, tables.agg(F.min("table_name")).first()[0]).distinct()


@query("SELECT * FROM (VALUES ('r_regionkey', 'int'), ('r_name', 'string')) t(column_name, type)")
def column_types(spark: SparkSession, d: str) -> DataFrame:
    return spark.createDataFrame(files.table_columns(read_table(spark, d, "region")), "column_name string, type string")


@query("""
WITH c AS (SELECT meta_id, pos, lower(trim(regexp_replace(country, '[\\s\\x{00A0}\\p{Z}]+', ' ', 'g'))) AS country, lower(trim(regexp_replace(column_name, '[\\s\\x{00A0}\\p{Z}]+', ' ', 'g'))) AS name
  FROM a_meta_table_of_columns JOIN (SELECT meta_id, any_value(country) AS country FROM a_meta_table GROUP BY 1) USING (meta_id))
SELECT meta_id, pos, CASE WHEN meta_id % 2 = 0 THEN name ELSE country || name END AS name FROM c""")
def country_prefixes(spark: SparkSession, d: str) -> DataFrame:
    """Column names that start with their table's country lose it; those that only run on from it don't."""
    country = read_table(spark, d, "a_meta_table").groupBy("meta_id").agg(F.first("country").alias("country"))
    cols = read_table(spark, d, "a_meta_table_of_columns").join(country, "meta_id")
    name = F.concat("country", F.when(F.col("meta_id") % 2 == 0, F.lit(" ")).otherwise(""), F.trim("column_name"))
    return cols.select("meta_id", "pos", X.strip_country_prefix(name, F.col("country")).alias("name"))


@query("SELECT name, path[2] AS branch, path[4] AS beyond FROM taxonomy_nodes")
def ancestors(spark: SparkSession, d: str) -> DataFrame:
    p = taxonomy.paths(read_table(spark, d, "taxonomy_nodes"))
    return p.select("name", taxonomy.ancestor(F.col("path"), 1).alias("branch"), taxonomy.ancestor(F.col("path"), 3).alias("beyond"))


@query(f"SELECT meta_id FROM ({REFERENCE['table_classes']}) WHERE equipment_class IS NULL")
def unclassified_tables(spark: SparkSession, d: str) -> DataFrame:
    return classification.unclassified(_classified(spark, d)).select("meta_id")


@query(f"""
WITH {_RULE_SQL.replace("texts AS (SELECT DISTINCT text FROM (SELECT unnest([section_h2, section_h3, section_h4]) AS text FROM a_meta_table) WHERE text IS NOT NULL AND text <> '')",
                        "texts AS (SELECT DISTINCT section_title AS text FROM a_meta_table WHERE section_title IS NOT NULL)")},
p AS (SELECT name AS entity, unnest(['equip_type', 'role']) AS super_col FROM taxonomy_nodes WHERE node_id % 2 = 0)
SELECT DISTINCT text, entity, p.super_col FROM hits LEFT JOIN p USING (entity)""")
def class_properties(spark: SparkSession, d: str) -> DataFrame:
    """Classes without a canonical column have those of their properties; here every other class has two."""
    nodes = read_table(spark, d, "taxonomy_nodes")
    hits = taxonomy.match_rules(read_table(spark, d, "a_meta_table").select(F.col("section_title").alias("text")), taxonomy.name_rules(nodes))
    of = nodes.where("node_id % 2 = 0").select(F.col("name").alias("entity"), F.explode(F.array(F.lit("equip_type"), F.lit("role"))).alias("super_col"))
    return mapping.class_columns(hits, of).select("text", "entity", "super_col")


@query("""
WITH f AS (SELECT DISTINCT meta_id, lower(trim(column_name)) AS feature FROM a_meta_table_of_columns),
m AS (SELECT DISTINCT meta_id, equipment_class AS grp FROM a_mapping_table WHERE equipment_class IS NOT NULL), n AS (SELECT grp, count(DISTINCT meta_id) AS n FROM m GROUP BY 1)
SELECT grp, feature, round(count(*) / any_value(n), 9) AS frequency FROM f JOIN m USING (meta_id) JOIN n USING (grp) GROUP BY 1, 2""")
def group_frequencies(spark: SparkSession, d: str) -> DataFrame:
    cols = read_table(spark, d, "a_meta_table_of_columns").select("meta_id", F.lit("raw_cols").alias("kind"), F.lower(F.trim("column_name")).alias("feature"))
    members = read_table(spark, d, "a_mapping_table").where("equipment_class IS NOT NULL").select("meta_id", F.col("equipment_class").alias("grp"))
    return classification.group_frequencies(cols, members, "meta_id").select("grp", "feature", F.round("frequency", 9).alias("frequency"))


@query()
def table_profiles_in_order(spark: SparkSession, d: str) -> DataFrame:
    """Classes by profile with tables taken one by one, groups growing in between; a chain of decisions that SQL can't state."""
    classified, features, groups = _features(spark, d)
    order = read_table(spark, d, "a_meta_table").select("meta_id", F.col("meta_id").alias("seq"))
    out = classification.classify_in_order(cut_lineage(classified), features, groups, order, key="meta_id")
    return out.select("meta_id", "equipment_class", F.round("confidence", 6).alias("confidence"))


@query("""
WITH s AS (SELECT country, sum(quantity_clean) FILTER (status = 'active')::BIGINT AS active FROM a_canonical_equipment GROUP BY 1)
SELECT *, row_number() OVER (ORDER BY active DESC NULLS LAST, country NULLS FIRST)::INT AS place FROM s QUALIFY place <= 10""")
def countries_by_active(spark: SparkSession, d: str) -> DataFrame:
    """A top-k report: the ten countries with the most active equipment, in order."""
    sums = summary.crosstab(read_table(spark, d, "a_canonical_equipment"), "country", "status", "quantity_clean", ["active"])
    return summary.top_rows(sums, "active", "country", 10)


@query("SELECT name, parent, len(list_filter(path, lambda p: p = 'Naval craft')) > 0 AS naval FROM taxonomy_nodes WHERE kind = 'class'")
def entities_of_a_kind(spark: SparkSession, d: str) -> DataFrame:
    """All classes, and whether one of them is an ancestor or the class itself."""
    nodes = read_table(spark, d, "taxonomy_nodes")
    below = taxonomy.descendants(taxonomy.paths(nodes), "Naval craft").select("name", F.lit(True).alias("naval"))
    return taxonomy.entities(nodes, "class").join(below, "name", "left").select("name", "parent", F.coalesce("naval", F.lit(False)).alias("naval"))


# --- older groupings ----------------------------------------------------------------------------------------------


@query(f"""
WITH m AS (SELECT raw_col, min(super_col) AS super_col FROM ({_LONG}) GROUP BY 1)
SELECT meta_id::VARCHAR AS table_name, lower(trim(column_name)) AS column_name, super_col FROM a_meta_table_of_columns LEFT JOIN m ON lower(trim(column_name)) = raw_col""")
def listed_columns(spark: SparkSession, d: str) -> DataFrame:
    cols = read_table(spark, d, "a_meta_table_of_columns").select(F.col("meta_id").cast("string").alias("table_name"), F.lower(F.trim("column_name")).alias("column_name"))
    known = _mapping(spark, d).groupBy("raw_col").agg(F.min("super_col").alias("super_col")).withColumnRenamed("raw_col", "raw")
    return legacy.map_columns(cols, known)


_PROFILE = """
WITH n AS (SELECT meta_id, country, {h2} AS a, {h3} AS b, {h4} AS c FROM a_meta_table),
lp AS (SELECT meta_id, country, coalesce(a, b, c) AS leaf, CASE WHEN c IS NOT NULL AND b IS NOT NULL THEN b ELSE a END AS parent FROM n),
k AS (SELECT meta_id, list_sort(list(DISTINCT equipment_class)) AS category FROM a_mapping_table WHERE equipment_class IS NOT NULL GROUP BY 1),
c AS (SELECT meta_id, list_sort(list(DISTINCT {col})) AS "column" FROM a_meta_table_of_columns WHERE column_name IS NOT NULL GROUP BY 1),
p AS (SELECT meta_id, country, list_filter([leaf], lambda x: x IS NOT NULL) AS header, list_filter([parent], lambda x: x IS NOT NULL) AS parent, coalesce(category, []) AS category,
  coalesce("column", []) AS "column" FROM lp LEFT JOIN k USING (meta_id) LEFT JOIN c USING (meta_id))
""".format(
    **{h[-2:]: f"CASE WHEN {h} <> '' THEN regexp_replace(regexp_replace(replace(lower(trim({h}, ' ')), ' ', '_'), '([^s])s$', '\\1'), '^s$', '') END" for h in ("section_h2", "section_h3", "section_h4")},
    col="regexp_replace(regexp_replace(replace(lower(trim(column_name, ' ')), ' ', '_'), '([^s])s$', '\\1'), '^s$', '')",
)


def _profiles(spark: SparkSession, d: str) -> DataFrame:
    classes = read_table(spark, d, "a_mapping_table").select("meta_id", F.col("equipment_class").alias("category"))
    return legacy.fingerprints(read_table(spark, d, "a_meta_table"), classes, read_table(spark, d, "a_meta_table_of_columns"), "meta_id")


@query(_PROFILE + "SELECT meta_id, array_to_string(header, '|') AS header, array_to_string(parent, '|') AS parent, array_to_string(category, '|') AS category, array_to_string(\"column\", '|') AS columns FROM p")
def old_fingerprints(spark: SparkSession, d: str) -> DataFrame:
    part = lambda name, alias: F.array_join(F.col("profile")[name], "|").alias(alias)
    return _profiles(spark, d).select("meta_id", part("header", "header"), part("parent", "parent"), part("category", "category"), part("column", "columns"))


def _jaccard(c: str) -> str:
    both = f'len(list_distinct(list_concat(t."{c}", r."{c}")))'
    return f'CASE WHEN {both} > 0 THEN len(list_intersect(t."{c}", r."{c}")) / {both} ELSE 0 END'


@query(_PROFILE + f""", first AS (SELECT country, min(meta_id) AS meta_id FROM p GROUP BY 1)
SELECT t.meta_id, round({" + ".join(f"{w} * {_jaccard(c)}" for c, w in legacy.WEIGHTS.items())}, 9) AS confidence
FROM p t JOIN first f ON t.country = f.country JOIN p r ON r.meta_id = f.meta_id""")
def cluster_confidence(spark: SparkSession, d: str) -> DataFrame:
    """How alike each table is to the first one of its country."""
    tables = _profiles(spark, d).join(read_table(spark, d, "a_meta_table").select("meta_id", F.col("country").alias("cluster")), "meta_id")
    first = tables.groupBy("cluster").agg(F.min_by("profile", "meta_id").alias("profile"))
    return legacy.confidence_to_representative(tables, first).select("meta_id", F.round("confidence", 9).alias("confidence"))
