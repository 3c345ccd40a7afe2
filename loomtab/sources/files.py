"""CSV and text readers, the taxonomy reader, and catalogue probes."""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def curated_links(spark: SparkSession, path: str) -> DataFrame:
    """``country, page_title, url`` of a CSV whose header and values carry spaces after the commas."""
    rows = spark.read.csv(path, header=True, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)
    trimmed = rows.toDF(*[c.strip() for c in rows.columns])
    return trimmed.select(F.trim("country_name").alias("country"), F.trim("page_title").alias("page_title"), F.trim("url").alias("url"))


def lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def csv_rows(spark: SparkSession, path: str) -> DataFrame:
    """``file, row_no, header, fields`` of every non-blank record of CSV files, headers included as record 0.

    Quotes may hold commas, doubled quotes and line breaks, so a file is read
    whole: these are curated lists, one task for each file.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        csv.field_size_limit((1 << 31) - 1)
        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = [r for r in csv.reader(io.StringIO(text or "", newline=""), skipinitialspace=True) if any(f.strip() for f in r)]
                for at in range(0, len(found), 10_000):
                    part = found[at : at + 10_000]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([name] * len(part)), pa.array(range(at, at + len(part)), pa.int64()),
                            pa.array([[h.strip() for h in found[0]]] * len(part), pa.list_(pa.string())), pa.array(part, pa.list_(pa.string())),
                        ],
                        ["file", "row_no", "header", "fields"],
                    )

    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    return whole.mapInArrow(run, "file string, row_no bigint, header array<string>, fields array<string>")


def records(spark: SparkSession, path: str) -> DataFrame:
    """``fields``: each record as a list of its fields, header included."""
    return csv_rows(spark, path).select("fields")


def _sided(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    body = csv_rows(spark, path).where("row_no > 0")
    fits = F.size("fields") == F.size("header")
    return body.where(fits), body.where(~fits).select(F.array_join("fields", ",").alias("line"))


def checked_records(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(rows as maps of the header, rejected records): records whose width differs from the header's are set aside, not lost.

    The header is skipped by place, so records equal to it stay. Of columns of
    the same name the last holds.
    """
    good, bad = _sided(spark, path)
    last = F.filter(F.arrays_zip("header", "fields"), lambda p, i: ~F.array_contains(F.slice("header", i + 2, F.size("header")), p["header"]))
    return good.select(F.map_from_entries(last).alias("fields")), bad


def checked_arrays(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(rows as lists without the header, rejected records), by width as :func:`checked_records`."""
    good, bad = _sided(spark, path)
    return good.select("row_no", "fields"), bad


def key_values(rows: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """One value per key: the last by ``order`` wins."""
    return rows.groupBy(key).agg(F.max_by(value, order).alias(value))


def key_lists(rows: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """All values per key in order; for curated lists, as a key's values are one cell of the result."""
    return rows.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct(order, value))), lambda s: s[value]).alias(value))


def first_column_set(rows: DataFrame, column: str) -> DataFrame:
    return rows.select(column).distinct()


def imported_files(spark: SparkSession, path: str, imports: Mapping[str, str]) -> list[str]:
    """The file and all those it imports, directly or through others; ``imports`` says where each imported address lies.

    An address that isn't listed raises, as its classes would be missing.
    """
    found, queue = [], [path]
    while queue:
        at = queue.pop(0)
        if at in found:
            continue
        found.append(at)
        heads = spark.read.format("xml").option("rowTag", "owl:Ontology").schema("`owl:imports` array<struct<`_rdf:resource`:string>>").load(at)
        for row in heads.select(F.explode("owl:imports").alias("i")).select(F.col("i")["_rdf:resource"].alias("address")).distinct().collect():
            if row["address"] not in imports:
                raise ValueError(f"{at} imports {row['address']}: say in imports where it lies")
            queue.append(imports[row["address"]])
    return found


def read_taxonomy(spark: SparkSession, path: str, imports: Mapping[str, str] = {}) -> tuple[DataFrame, DataFrame]:
    """(nodes, rules) of an RDF/XML taxonomy and the ones it imports.

    ``nodes``: name, kind, parent, with the part of an address after ``#`` as
    name. A class with several parents keeps the one under the branch named
    first in the alphabet. ``rules``: entity, kind, patterns, super_col.
    """
    kinds = {"owl:Class": "class", "owl:ObjectProperty": "object property", "owl:DatatypeProperty": "data property"}
    schema = (
        "`_rdf:about` string, `hasRegex` array<string>, `super_col` array<string>, "
        "`rdfs:subClassOf` array<struct<`_rdf:resource`:string>>, `rdfs:subPropertyOf` array<struct<`_rdf:resource`:string>>"
    )
    parts = []
    sources = imported_files(spark, path, imports)
    for tag, kind in kinds.items():
        raw = spark.read.format("xml").option("rowTag", tag).schema(schema).load(sources)
        up = F.concat(F.coalesce("rdfs:subClassOf", F.array()), F.coalesce("rdfs:subPropertyOf", F.array()))
        parents = F.filter(F.transform(up, lambda p: F.substring_index(p["_rdf:resource"], "#", -1)), lambda p: p.isNotNull() & (p != ""))
        parts.append(
            raw.where("`_rdf:about` IS NOT NULL").select(
                F.substring_index("_rdf:about", "#", -1).alias("name"), F.lit(kind).alias("kind"), F.array_min(parents).alias("parent"),
                F.coalesce("hasRegex", F.array().cast("array<string>")).alias("patterns"), F.get("super_col", F.lit(0)).alias("super_col"),
            )
        )
    every = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return every.select("name", "kind", "parent"), every.select(F.col("name").alias("entity"), "kind", "patterns", "super_col")


def read_domains(spark: SparkSession, path: str, imports: Mapping[str, str] = {}) -> DataFrame:
    """``property, entity, super_col`` of an RDF/XML taxonomy: the classes each property is declared for."""
    schema = "`_rdf:about` string, `super_col` array<string>, `rdfs:domain` array<struct<`_rdf:resource`:string>>"
    parts = []
    for tag in ("owl:ObjectProperty", "owl:DatatypeProperty"):
        raw = spark.read.format("xml").option("rowTag", tag).schema(schema).load(imported_files(spark, path, imports)).where("`_rdf:about` IS NOT NULL")
        parts.append(
            raw.select(
                F.substring_index("_rdf:about", "#", -1).alias("property"), F.explode("rdfs:domain").alias("d"), F.get("super_col", F.lit(0)).alias("super_col")
            ).select("property", F.substring_index(F.col("d")["_rdf:resource"], "#", -1).alias("entity"), "super_col")
        )
    return parts[0].unionByName(parts[1]).where("entity <> ''")


def ensure_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table at ``path``; an empty one of this schema is written first if there is none. An existing table is left as it is."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
    spark.createDataFrame([], schema).write.mode("ignore").parquet(path)
    return spark.read.schema(schema).parquet(path)


def data_tables(names: DataFrame, column: str = "table_name", reserved: str = "a_") -> DataFrame:
    """Table names without the catalogue's own."""
    return names.where(~F.startswith(F.col(column), F.lit(reserved)))


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def table_columns(df: DataFrame) -> list[tuple[str, str]]:
    return df.dtypes


def seed_catalogue(names: DataFrame, column: str = "name") -> DataFrame:
    """``table_name, country`` with the country that stands before ``_table_``; other names have an empty one."""
    at = F.instr(F.col(column), "_table_")
    return names.select(F.col(column).alias("table_name"), F.substr(F.col(column), F.lit(1), F.greatest(at - 1, F.lit(0))).alias("country"))


def catalogue(names: DataFrame, rows: DataFrame | None = None, columns: DataFrame | None = None, column: str = "name") -> DataFrame:
    """``table_name, country, row_count, column_count, category_guess`` of each data table.

    ``rows`` and ``columns`` hold one row per row and per column of a table
    under ``table_name``; without them the counts are NULL, and a table without
    any has 0. The guess is left open, for people to fill in.
    """
    listed = seed_catalogue(data_tables(names, column), column)

    def counts(of: DataFrame | None, name: str) -> DataFrame:
        if of is None:
            return listed.select("table_name", F.lit(None).cast("bigint").alias(name)).distinct()
        return listed.select("table_name").distinct().join(of.groupBy("table_name").agg(F.count(F.lit(1)).alias(name)), "table_name", "left").fillna(0, [name])

    both = listed.distinct().join(counts(rows, "row_count"), "table_name").join(counts(columns, "column_count"), "table_name")
    return both.select("table_name", "country", "row_count", "column_count", F.lit(None).cast("string").alias("category_guess"))


def country_of_table(tables: DataFrame, name: str) -> DataFrame:
    """Point lookup: the country of one table in lower case; no row if the table isn't listed."""
    return tables.where(F.col("table_name") == name).select(F.lower("country").alias("country"))


def last_wins(rows: DataFrame, key: str, order: tuple[str, ...]) -> DataFrame:
    """One whole row per key, the last by ``order``: an upsert by primary key.

    Rows travel as one struct through a partial aggregation, so a key with very
    many rows is reduced before the shuffle.
    """
    others = [c for c in rows.columns if c != key]
    best = rows.groupBy(key).agg(F.max_by(F.struct(*others), F.struct(*order)).alias("r"))
    return best.select(key, "r.*").select(*rows.columns)


def drop_tables(rows: DataFrame, dropped: DataFrame, key: str = "table_name") -> DataFrame:
    return rows.join(dropped.select(key).distinct(), key, "left_anti")


def numbered_occurrences(rows: DataFrame, group: str, order: str, name: str) -> DataFrame:
    """``name`` with ``_2``, ``_3`` … on repeats within a group."""
    n = F.row_number().over(W.partitionBy(group, name).orderBy(order))
    return rows.withColumn(name, F.when(n > 1, F.concat(F.col(name), F.lit("_"), n.cast("string"))).otherwise(F.col(name)))
