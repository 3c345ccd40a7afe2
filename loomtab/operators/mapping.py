"""Raw columns mapped to canonical ones, and all tables united into one master table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomtab.schemas import CANONICAL_COLUMNS

#: Raw names that may stand for the equipment's name (fixed value).
NAME_LIKE = r"(?i)^(name|ship$|model|make|family)$"


def classify_columns(columns: DataFrame, matches: DataFrame) -> DataFrame:
    """``table_name, raw_col, super_col, ord`` for every raw column.

    ``columns`` has ``table_name, column_name, pos``; ``matches`` has ``text,
    super_col`` of the rules that hit a name. ``section`` feeds sub_class; a
    name whose rules agree on one canonical column feeds it; ``quantity`` feeds
    quantity. A table left without equip_type takes its first candidate among
    the rest (a name that hits equip_type or looks like a name), else its only
    other_names column, else its only variant column. What is left feeds note.
    """
    hit = matches.where("super_col IS NOT NULL").groupBy("text").agg(F.array_sort(F.collect_set("super_col")).alias("hits"))
    named = columns.select("table_name", F.col("column_name").alias("raw_col"), F.col("pos").alias("ord"))
    joined = named.join(hit.withColumnRenamed("text", "raw_col"), "raw_col", "left").withColumn("hits", F.coalesce("hits", F.array().cast("array<string>")))
    direct = (
        F.when(F.col("raw_col") == "section", F.lit("sub_class"))
        .when(F.size("hits") == 1, F.element_at("hits", 1))
        .when(F.col("raw_col") == "quantity", F.lit("quantity"))
    )
    first = joined.withColumn("direct", direct)
    candidate = F.col("direct").isNull() & (F.array_contains("hits", "equip_type") | F.col("raw_col").rlike(NAME_LIKE))
    table = W.partitionBy("table_name")
    facts = (
        first.withColumn("candidate", candidate)
        .withColumn("has_type", F.max(F.coalesce(F.col("direct") == "equip_type", F.lit(False))).over(table))
        .withColumn("first_candidate", F.min(F.when(F.col("candidate"), F.col("ord"))).over(table))
        .withColumn("n_other", F.count_if(F.col("direct") == "other_names").over(table))
        .withColumn("n_variant", F.count_if(F.col("direct") == "variant").over(table))
    )
    open_ = ~F.col("has_type")
    none = F.col("first_candidate").isNull()
    promoted = (
        F.when(open_ & F.col("candidate") & (F.col("ord") == F.col("first_candidate")), True)
        .when(open_ & none & (F.col("n_other") == 1) & (F.col("direct") == "other_names"), True)
        .when(open_ & none & (F.col("n_other") != 1) & (F.col("n_variant") == 1) & (F.col("direct") == "variant"), True)
        .otherwise(False)
    )
    return facts.select("table_name", "raw_col", F.when(promoted, F.lit("equip_type")).otherwise(F.coalesce("direct", F.lit("note"))).alias("super_col"), "ord")


def mapping_report(tables: DataFrame, mapping: DataFrame, columns: Sequence[str] = CANONICAL_COLUMNS) -> DataFrame:
    """One line per table: its class, other classes, confidence, and per canonical column the raw ones joined by ``, ``."""
    listed = mapping.groupBy("table_name").pivot("super_col", list(columns)).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "raw_col"))), lambda c: c["raw_col"]), ", ")
    )
    head = tables.select("table_name", "equipment_class", F.array_join("other_classes", ", ").alias("other_classes"), "confidence")
    return head.join(listed, "table_name", "left")


def unpivot_report(report: DataFrame, fields: Sequence[str]) -> DataFrame:
    """``table_name, super_col, raw_col, ord``: the report in long form again."""
    long = report.select("table_name", F.inline(F.array(*[F.struct(F.lit(f).alias("super_col"), F.col(f).alias("names")) for f in fields])))
    return long.where("names IS NOT NULL AND names <> ''").select("table_name", "super_col", F.posexplode(F.split("names", ", ")).alias("ord", "raw_col"))


def _feeds(column: str):
    return lambda x: x["super_col"] == column


def build_master(
    rows: DataFrame, mapping: DataFrame, tables: DataFrame, columns: Sequence[str] = CANONICAL_COLUMNS, keys: Sequence[str] = ("table_name", "row_idx")
) -> DataFrame:
    """All rows of all tables under the canonical columns.

    ``tables`` has ``table_name, url`` and the table's own country, class_path
    and sub_class. A canonical cell is the table's value and the raw values in
    order, joined by ``; ``. A NULL among them makes the whole cell NULL, as
    concatenation does in SQL. The routes of a table are one list, joined to its
    rows once; cells are routed within their row, so none is shuffled.
    """
    meta_of = ("country", "class_path", "sub_class")
    routes = mapping.groupBy("table_name").agg(F.collect_list(F.struct("raw_col", "super_col", "ord")).alias("__routes"))
    heads = tables.select("table_name", "url", *[F.col(c).alias(f"meta_{c}") for c in meta_of]).join(routes, "table_name", "full")
    placed = rows.select(*keys, "cells").join(heads, "table_name", "left")

    def routed(c):
        mine = F.filter("__routes", lambda r: r["raw_col"] == c["name"])
        return F.transform(mine, lambda r: F.struct(r["super_col"].alias("super_col"), r["ord"].alias("ord"), c["value"].alias("value")))

    none = F.array().cast(f"array<struct<super_col:string,ord:{mapping.schema['ord'].dataType.simpleString()},value:string>>")
    fed = F.coalesce(F.flatten(F.transform("cells", routed)), none)
    placed = placed.select(*keys, "url", *[f"meta_{c}" for c in meta_of], fed.alias("__fed"))
    joined = placed.withColumns(
        {f"raw_{c}": F.array_sort(F.transform(F.filter("__fed", _feeds(c)), lambda x: F.struct(x["ord"].alias("ord"), x["value"].alias("value")))) for c in columns}
    )

    def cell(c: str):
        raw = F.col(f"raw_{c}")
        values = F.transform(raw, lambda v: v["value"])
        joined_ = F.when(~F.exists(values, lambda v: v.isNull()), F.array_join(values, "; "))
        if c not in meta_of:
            return F.when(F.size(raw) > 0, joined_)
        meta = F.col(f"meta_{c}")
        return F.when(F.size(raw) == 0, meta).when(meta.isNull(), joined_).otherwise(F.concat(meta, F.lit("; "), joined_))

    return joined.select(*keys, "url", *[cell(c).alias(c) for c in columns])


def class_columns(matches: DataFrame, properties: DataFrame) -> DataFrame:
    """Rule matches in which a class without a canonical column of its own has those of its properties.

    ``matches`` has ``text, entity, kind, super_col``; ``properties`` has
    ``entity, super_col``, one row per class and property. A class without
    properties keeps its NULL; other matches stay as they are; repeats count once.
    """
    of = properties.where("super_col IS NOT NULL").select("entity", F.col("super_col").alias("__of")).distinct()
    climbs = (F.col("kind") == "class") & F.col("super_col").isNull()
    joined = matches.join(of, "entity", "left")
    return joined.select("text", "entity", "kind", F.when(climbs, F.col("__of")).otherwise(F.col("super_col")).alias("super_col")).distinct()
