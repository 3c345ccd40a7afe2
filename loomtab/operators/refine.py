"""Repair of each row's class: contestants, rules, nearest common ancestors, and where the rest goes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtab.functions.text import singularize
from loomtab.operators.taxonomy import leafmost, match_rules, nearest_common_ancestor, path_text

#: Where classes under the mission branch go, by their first level (fixed values); others go to note.
MISSION_COLUMNS = {"Role": "role", "Capability": "capability", "Propulsion": "propulsion", "Status": "status"}
EQUIPMENT, MISSION = "Equipment", "EquipMission"


def contestants(sub_class):
    """The singular, trimmed, non-empty parts of a class cell."""
    parts = F.transform(F.split(sub_class, ";"), lambda x: singularize(F.trim(x)))
    return F.filter(parts, lambda x: x != "")


def fix_classes(
    rows: DataFrame, rules: DataFrame, paths: DataFrame, cells: Sequence[str], id_: str = "row_id", collapse: str = "ancestor",
    equipment: str = EQUIPMENT, mission: str = MISSION, mission_columns: dict[str, str] = MISSION_COLUMNS,
) -> DataFrame:
    """Rows with ``sub_class, class_path, note`` and the mission columns repaired, and ``unknown`` contestants.

    Each contestant meets the rules once per distinct text. Classes of the
    equipment branch compete: all alike win, else their nearest common ancestor
    (``collapse="leaf"`` drops ancestors of other matches first). Classes of the
    mission branch replace the text of the column of their first level, joined
    by ``; ``. Contestants, losing classes, and everything without a place go to
    note, once, sorted, unless the row says it elsewhere. Rows without a class
    cell stay as they are; with one but without an equipment class, sub_class
    becomes NULL and class_path stays.
    """
    asked = rows.select(F.col(id_).alias("__id"), F.posexplode(contestants(F.col("sub_class"))).alias("i", "contestant")).where("contestant IS NOT NULL")
    matched = match_rules(asked.select(F.col("contestant").alias("text")), rules)
    placed = matched.join(paths.select(F.col("name").alias("entity"), "path"), "entity", "left").select(
        F.col("text").alias("contestant"), "entity", "path", F.get("path", F.lit(0)).alias("root"), F.get("path", F.lit(1)).alias("level1")
    )
    case = F.lit(None).cast("string")
    for level, column in mission_columns.items():
        case = F.when(F.col("level1") == level, F.lit(column)).otherwise(case)
    hits = asked.join(placed, "contestant", "left").withColumn("goes", F.when(F.col("root") == mission, case))
    is_class = F.col("root") == equipment
    ignored = F.col("root").isNotNull() & ~F.col("root").isin(equipment, mission)
    known = F.col("entity").isNotNull()
    found = hits.groupBy("__id").agg(
        F.array_sort(F.collect_list(F.when(is_class, F.struct("i", "entity", "path")))).alias("classes"),
        F.array_sort(F.collect_list(F.when(F.col("goes").isNotNull(), F.struct("goes", "i", "entity")))).alias("moved"),
        F.collect_set(F.when(~known | ~ignored, F.col("contestant"))).alias("noted"),
        F.array_sort(F.collect_set(F.when(~known, F.col("contestant")))).alias("unknown"),
    )
    ways = F.transform("classes", lambda c: c["path"])
    names = F.array_distinct(F.transform("classes", lambda c: c["entity"]))
    final = F.when(F.size(names) == 1, F.element_at(names, 1)).otherwise(nearest_common_ancestor(leafmost(ways) if collapse == "leaf" else ways))
    best = found.select("__id", "moved", "noted", "unknown", "classes", names.alias("names"), final.alias("final"))
    # the path of the winner is the beginning of any contestant's path that ends in it
    won = F.get(F.filter(F.transform("classes", lambda c: F.slice(c["path"], F.lit(1), F.array_position(c["path"], F.col("final")).cast("int"))), lambda p: F.size(p) > 0), F.lit(0))
    best = best.withColumn("won", F.when(F.col("final").isNotNull(), path_text(won)))
    joined = rows.join(best, rows[id_] == best["__id"], "left").drop("__id")
    asked_here = F.col("unknown").isNotNull()
    out = joined
    for column in mission_columns.values():
        values = F.transform(F.filter("moved", _goes_to(column)), lambda m: m["entity"])
        out = out.withColumn(column, F.when(asked_here & (F.size(values) > 0), F.array_join(values, "; ")).otherwise(F.col(column)))
    out = out.withColumn("sub_class", F.when(asked_here, F.col("final")).otherwise(F.col("sub_class")))
    out = out.withColumn("class_path", F.when(F.col("won").isNotNull(), F.col("won")).otherwise(F.col("class_path")))
    spoken = F.filter(F.array(*[F.col(c).cast("string") for c in cells if c != "note"]), lambda v: v.isNotNull())
    losers = F.filter("names", lambda n: ~n.eqNullSafe(F.col("final")))
    notes = F.array_sort(F.array_except(F.array_union("noted", losers), spoken))
    out = out.withColumn("note", F.when(asked_here & (F.size(notes) > 0), F.array_join(notes, "; ")).otherwise(F.col("note")))
    return out.select(*rows.columns, F.coalesce("unknown", F.array().cast("array<string>")).alias("unknown"))


def _goes_to(column: str):
    return lambda m: m["goes"] == column


def unknown_contestants(fixed: DataFrame) -> DataFrame:
    """The distinct contestants that no rule knows: what to add to the taxonomy."""
    return fixed.select(F.explode("unknown").alias("contestant")).distinct()


def collapse_lists(rows: DataFrame, columns: Sequence[str], separator: str = "; ") -> DataFrame:
    """Array columns as text; NULL items are left out."""
    return rows.withColumns({c: F.array_join(c, separator) for c in columns})
