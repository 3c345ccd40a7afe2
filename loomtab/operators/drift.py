"""Schemas that drift between deliveries: versions, migration steps, and one consistent table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomtab.operators.snapshots import snapshot_chain
from loomtab.schemas import MAPPED_FIELDS
from loomtab.session import cut_lineage

#: Families of type names (fixed values, lower case; sizes and parameters in brackets are cut off first).
FAMILIES = {
    "text": ("text", "varchar", "string", "object", "str", "char", "clob", "nvarchar", "category", "utf8"),
    "whole number": ("int", "integer", "bigint", "smallint", "tinyint", "long", "short", "int8", "int16", "int32", "int64", "uint8", "uint16", "uint32", "uint64"),
    "real number": ("float", "double", "real", "decimal", "numeric", "number", "float16", "float32", "float64", "double precision"),
    "date or time": ("date", "time", "timestamp", "datetime", "datetime64", "timestamptz", "timestamp_ntz", "date32", "date64", "interval"),
}


def column_key(name: Column) -> Column:
    """Lower case, with underscores and runs of white space as one space, trimmed."""
    return F.trim(F.regexp_replace(F.lower(name), r"[_\s\p{Z}]+", " "))


def type_family(name: Column) -> Column:
    bare = F.trim(F.regexp_replace(F.lower(name), r"[\[(<].*$", ""))
    case = F
    for family, names in FAMILIES.items():
        case = case.when(bare.isin(*names), F.lit(family))
    return case.otherwise(F.lit(None).cast("string"))


#: Parts a column's name, family and field in its sign.
_PART = "\u0001"


def _sign(name: Column, family: Column, field: Column) -> Column:
    return F.concat_ws(_PART, name, F.coalesce(family, F.lit("?")), F.coalesce(field, F.lit("")))


def column_of(sign: Column) -> Column:
    """The struct (name, family, field) that a sign stands for."""
    part = lambda i: F.split_part(sign, F.lit(_PART), F.lit(i))
    return F.struct(part(1).alias("name"), F.nullif(part(2), F.lit("?")).alias("family"), F.nullif(part(3), F.lit("")).alias("field"))


def snapshot_schemas(columns: DataFrame, mapping: DataFrame, chain: DataFrame, fields: Sequence[str] = MAPPED_FIELDS) -> DataFrame:
    """``snapshot_id, table_name, at, prev_id, cols, fingerprint``: the schema of each snapshot as one sorted list of signs (see :func:`column_of`).

    Names that differ only in writing are one column. Its type is the first
    known one by delivery; ``field`` is the canonical field it feeds, the first
    by canonical order if several, else NULL. The fingerprint is a hash of the
    list, so snapshots of equal fingerprints have equal schemas; one without
    columns has that of the empty list. Columns meet once, by delivery; only
    snapshots of several deliveries are put together from their parts.
    """
    named = columns.select("meta_id", F.translate(column_key(F.col("column_name")), _PART, "").alias("name"), type_family(F.col("value_type")).alias("family")).where("name <> ''")
    told = named.groupBy("meta_id").agg(F.collect_list(F.struct("name", "meta_id", "family")).alias("told"))

    def feeding(rank: int, f: str) -> Column:
        return F.transform(F.split(F.coalesce(F.col(f), F.lit("")), ","), lambda n: F.struct(column_key(n).alias("name"), F.lit(rank).alias("rank"), F.lit(f).alias("field")))

    lists = F.flatten(F.array(*[feeding(i, f) for i, f in enumerate(fields)]))
    fed = mapping.select("meta_id", F.filter(lists, lambda x: x["name"] != "").alias("fed")).groupBy("meta_id").agg(F.flatten(F.collect_list("fed")).alias("fed"))
    none = lambda c, kind: F.coalesce(c, F.array().cast(kind))
    parts = chain.select("meta_id", "table_name", "at", "snapshot_id", "prev_id", "n_deliveries").join(told, "meta_id", "left").join(fed, "meta_id", "left")
    parts = parts.withColumns({
        "told": none("told", "array<struct<name:string,meta_id:bigint,family:string>>"), "fed": none("fed", "array<struct<name:string,rank:int,field:string>>")
    })
    keys = ["snapshot_id", "table_name", "at", "prev_id"]
    several = parts.where("n_deliveries > 1").groupBy(*keys).agg(F.flatten(F.collect_list("told")).alias("told"), F.flatten(F.collect_list("fed")).alias("fed"))
    whole = parts.where("n_deliveries = 1").select(*keys, "told", "fed").unionByName(several)
    whole = whole.withColumn("names", F.array_sort(F.array_distinct(F.transform("told", lambda c: c["name"]))))
    of = lambda c, n, part: F.filter(c, lambda x: (x["name"] == n) & x[part].isNotNull())
    family = lambda n: F.array_min(F.transform(of("told", n, "family"), lambda x: F.struct(x["meta_id"], x["family"].alias("family"))))["family"]
    field = lambda n: F.array_min(F.transform(of("fed", n, "field"), lambda x: F.struct(x["rank"], x["field"].alias("field"))))["field"]
    full = whole.select(*keys, F.transform("names", lambda n: _sign(n, family(n), field(n))).alias("cols"))
    return full.withColumn("fingerprint", F.sha2(F.array_join("cols", "\u0002"), 256))


def schema_versions(columns: DataFrame, mapping: DataFrame, meta: DataFrame) -> DataFrame:
    """``meta_id, table_name, at, fingerprint, n_columns, is_new_version`` of each snapshot; the first of a table is a new version."""
    full = snapshot_schemas(columns, mapping, snapshot_chain(meta))
    full = full.select("snapshot_id", "table_name", "at", "prev_id", "fingerprint", F.size("cols").alias("n_columns"))
    before = full.select(F.col("snapshot_id").alias("prev_id"), F.col("fingerprint").alias("before"))
    return full.join(before, "prev_id", "left").select(
        F.col("snapshot_id").alias("meta_id"), "table_name", "at", "fingerprint", "n_columns",
        (~F.col("fingerprint").eqNullSafe(F.col("before"))).alias("is_new_version"),
    )


def _steps_between(pairs: DataFrame) -> DataFrame:
    """``old_print, new_print`` and the steps that lead from the schema ``old`` to ``new``, within each row."""
    names = lambda c: F.transform(c, lambda x: x["name"])
    same = lambda values, f: F.size(F.filter(values, lambda x: x == f))
    step = lambda kind, old, new: F.struct(
        F.lit(kind).alias("change_kind"), F.coalesce(old["name"], F.lit("")).alias("old_name"), F.coalesce(new["name"], F.lit("")).alias("new_name"),
        old["family"].alias("old_family"), new["family"].alias("new_family"),
    )
    none = F.lit(None).cast("struct<name:string,family:string,field:string>")
    # columns of equal signs make no step, so only the differences are looked at
    p = pairs.select(
        "old_print", "new_print", F.transform(F.array_except("old", "new"), column_of).alias("old"), F.transform(F.array_except("new", "old"), column_of).alias("new")
    )
    p = p.withColumns({"old_names": names("old"), "new_names": names("new")})
    p = p.withColumns({
        "gone": F.filter("old", lambda c: ~F.array_contains("new_names", c["name"])), "came": F.filter("new", lambda c: ~F.array_contains("old_names", c["name"])),
        # both lists are sorted by name, so what stayed stands side by side
        "stayed": F.zip_with(
            F.filter("old", lambda c: F.array_contains("new_names", c["name"])), F.filter("new", lambda c: F.array_contains("old_names", c["name"])),
            lambda a, b: F.struct(a.alias("old"), b.alias("new")),
        ),
    })
    fed = lambda c: F.array_compact(F.transform(c, lambda x: x["field"]))
    p = p.withColumns({"gone_fields": fed("gone"), "came_fields": fed("came")})
    p = p.withColumn("fields", F.filter(F.array_intersect("gone_fields", "came_fields"), lambda f: (same("gone_fields", f) == 1) & (same("came_fields", f) == 1)))
    one = lambda c, f: F.get(F.filter(c, lambda x: x["field"] == f), F.lit(0))
    p = p.withColumn("renamed", F.transform("fields", lambda f: F.struct(one("gone", f).alias("old"), one("came", f).alias("new"))))
    left = lambda c: F.filter(c, lambda x: ~F.coalesce(F.array_contains("fields", x["field"]), F.lit(False)))
    retyped = F.filter(F.concat("stayed", "renamed"), lambda s: s["old"]["family"] != s["new"]["family"])
    return p.select(
        "old_print", "new_print",
        F.concat(
            F.transform("renamed", lambda s: step("renamed", s["old"], s["new"])), F.transform(left("gone"), lambda c: step("removed", c, none)),
            F.transform(left("came"), lambda c: step("added", none, c)), F.transform(retyped, lambda s: step("retyped", s["old"], s["new"])),
        ).alias("steps"),
    )


def migration_steps(columns: DataFrame, mapping: DataFrame, meta: DataFrame) -> DataFrame:
    """``meta_id, change_kind, old_name, new_name, old_family, new_family``: each change between consecutive snapshots.

    Versions are schema fingerprints. Only snapshots whose fingerprint differs
    from the one before are looked at; the steps are worked out once for each
    distinct pair of versions, within a row, and go back to all snapshots that
    took them.

    Kinds are ``renamed``, ``removed``, ``added`` and ``retyped``. A rename is
    the only column that left and the only one that came under one canonical
    field; columns that feed no field are never renamed. A column that stayed
    or was renamed is also retyped if both families are known and differ.

    Unknown types and NULL or blank column names make no step; order is no
    change. Snapshots are those of :func:`snapshot_chain`, so the first of a
    table has no steps, and one without columns removes all. Repeated rows
    count once; empty inputs give an empty result.
    """
    return _steps_of(cut_lineage(snapshot_schemas(columns, mapping, snapshot_chain(meta))))


def _steps_of(schemas: DataFrame) -> DataFrame:
    before = schemas.select(F.col("snapshot_id").alias("prev_id"), F.col("fingerprint").alias("old_print"))
    moves = schemas.select("snapshot_id", "prev_id", F.col("fingerprint").alias("new_print")).join(before, "prev_id").where("old_print <> new_print")
    pairs = moves.select("old_print", "new_print").distinct()
    asked = pairs.select(F.explode(F.array("old_print", "new_print")).alias("fingerprint")).distinct()
    versions = schemas.select("fingerprint", "cols").join(asked, "fingerprint", "left_semi").groupBy("fingerprint").agg(F.first("cols").alias("cols"))
    pairs = pairs.join(versions.select(F.col("fingerprint").alias("old_print"), F.col("cols").alias("old")), "old_print")
    pairs = pairs.join(versions.select(F.col("fingerprint").alias("new_print"), F.col("cols").alias("new")), "new_print")
    # outer, as a filter on the list would move below and work it out again
    steps = _steps_between(pairs).select("old_print", "new_print", F.inline_outer("steps")).where("change_kind IS NOT NULL")
    return moves.join(steps, ["old_print", "new_print"]).drop("old_print", "new_print", "prev_id").withColumnRenamed("snapshot_id", "meta_id")


def clashing_names(columns: DataFrame, meta: DataFrame) -> DataFrame:
    """``meta_id, name, raw_names``: columns of one delivery that differ only in writing, and so are one column of several values."""
    seen = columns.select("meta_id", column_key(F.col("column_name")).alias("name"), F.col("column_name").alias("raw")).where("name <> ''")
    chain = snapshot_chain(meta).select("meta_id")
    found = seen.join(chain, "meta_id", "left_semi").groupBy("meta_id", "name").agg(F.array_sort(F.collect_set("raw")).alias("raw_names"))
    return found.where(F.size("raw_names") > 1)


def final_names(steps: DataFrame, chain: DataFrame, rounds: int = 20) -> DataFrame:
    """``table_name, since, name, final_name, until, renamed``: where each column that goes ends up by the chain of later renames.

    ``since`` is the time of the step that takes ``name`` away, a rename or
    (``renamed`` is false) a removal. ``until`` is the time of the removal that
    ends the chain, NULL if it stands to the end. Each round
    follows twice as many renames as the one before, so ``rounds`` bounds the
    length of a chain by 2 to that power; the loop ends when nothing moves.
    """
    when = chain.select(F.col("snapshot_id").alias("meta_id"), "table_name", "at").distinct()
    ends = steps.where("change_kind IN ('renamed', 'removed')").join(when, "meta_id")
    events = ends.select("table_name", F.col("at").alias("since"), F.col("old_name").alias("name"), "change_kind", F.col("new_name").alias("final_name"))
    # the next event of the name that this rename gives, after this rename
    following = events.select("table_name", F.col("name").alias("final_name"), F.struct("since", "change_kind", F.col("final_name").alias("to")).alias("nx"))
    renames = events.where("change_kind = 'renamed'").drop("change_kind")
    hop = renames.join(following, ["table_name", "final_name"], "left").where("nx IS NULL OR nx.since > since")
    kept = renames.join(hop.groupBy("table_name", "since", "name").agg(F.min("nx").alias("nx")), ["table_name", "since", "name"], "left")
    links = cut_lineage(
        kept.select(
            "table_name", "since", "name", "final_name", F.when(F.col("nx.change_kind") == "renamed", F.col("nx.since")).alias("next_since"),
            F.when(F.col("nx.change_kind") == "removed", F.col("nx.since")).alias("until"),
        )
    )
    for _ in range(rounds):
        if links.where("next_since IS NOT NULL").isEmpty():
            break
        onward = links.select(
            "table_name", F.col("since").alias("next_since"), F.col("name").alias("final_name"), F.col("final_name").alias("far"), F.col("next_since").alias("far_since"),
            F.col("until").alias("far_until"),
        )
        links = cut_lineage(
            links.join(onward, ["table_name", "next_since", "final_name"], "left").select(
                "table_name", "since", "name", F.coalesce("far", "final_name").alias("final_name"), F.col("far_since").alias("next_since"), F.coalesce("far_until", "until").alias("until")
            )
        )
    removals = events.where("change_kind = 'removed'").select("table_name", "since", "name", F.col("name").alias("final_name"), F.col("since").alias("until"))
    return links.drop("next_since").withColumn("renamed", F.lit(True)).unionByName(removals.withColumn("renamed", F.lit(False)))


def consistent_rows(raw_rows: DataFrame, columns: DataFrame, mapping: DataFrame, meta: DataFrame) -> DataFrame:
    """``meta_id, table_name, row_idx, column_name, value_no, family, value, value_cast``: all rows under the latest column names.

    Each cell's column is carried through the later renames of its table. A
    column that a table's snapshot lacks but a later or earlier one has comes
    out with a NULL value (the default), so all snapshots of a table have the
    same columns. ``family`` is the column's newest known type; a value that
    can't be cast to it stays as text in ``value`` and is NULL in ``value_cast``.
    NULL cells stay NULL; rows without cells give only defaults.

    No cell is lost. A removed column and a later one of the same name share
    it; only where they clash, as a snapshot has both under their names of the
    time, the removed one comes out under ``name (until time)``. Cells of one
    row whose raw names differ only in writing are one column, numbered by
    ``value_no`` in their order (see :func:`clashing_names`). Cells under names
    that their snapshot doesn't list come out under those names, without a
    family.

    The routes of a snapshot are one map and the columns of a table one list,
    joined to the rows once, so cells are never shuffled.
    """
    chain = snapshot_chain(meta)
    schemas = cut_lineage(snapshot_schemas(columns, mapping, chain))
    names = final_names(cut_lineage(_steps_of(schemas)), chain)
    known = schemas.select("snapshot_id", "table_name", "at", F.inline(F.transform("cols", column_of))).drop("field")
    routed = known.join(names, ["table_name", "name"], "left").groupBy("snapshot_id", "table_name", "at", "name", "family").agg(
        F.min(F.when(F.col("renamed") & (F.col("since") > F.col("at")), F.struct("since", "final_name"))).alias("r"),
        F.min(F.when(F.col("since") > F.col("at"), F.struct("since", "final_name", "until"))).alias("e"),
    )
    # a later 'removed' ends a name, so a column that comes again under it is another one only by time; they share the name unless they clash
    routed = routed.select(
        "snapshot_id", "table_name", "at", "name", "family", F.coalesce("r.final_name", "name").alias("final_name"),
        F.coalesce("e.final_name", "name").alias("own_name"), F.col("e.until").alias("until"),
    )
    clash = F.count(F.lit(1)).over(W.partitionBy("snapshot_id", "final_name")) > 1
    clashes = F.max("clash").over(W.partitionBy("table_name", "own_name", "until"))
    apart = F.concat("own_name", F.lit(" (until "), F.col("until").cast("string"), F.lit(")"))
    routed = routed.withColumn("clash", clash).withColumn("clashes", clashes)
    routed = cut_lineage(routed.withColumn("final_name", F.when(F.col("clashes") & F.col("until").isNotNull(), apart).otherwise(F.col("final_name"))))
    finals = routed.groupBy("table_name", "final_name").agg(F.max_by("family", F.when(F.col("family").isNotNull(), F.col("at"))).alias("family"))
    finals = finals.groupBy("table_name").agg(F.collect_list(F.struct(F.col("final_name").alias("column_name"), "family")).alias("finals"))
    routes = routed.groupBy("snapshot_id").agg(F.map_from_entries(F.collect_list(F.struct("name", "final_name"))).alias("routes"))
    routes = chain.select("meta_id", "snapshot_id").join(routes, "snapshot_id").select("meta_id", "routes")
    placed = raw_rows.select("meta_id", "table_name", "row_idx", "cells").join(routes, "meta_id", "left").join(finals, "table_name", "left")

    def routed_cell(c: Column) -> Column:
        key = column_key(c["name"])
        return F.struct(F.coalesce(F.try_element_at("routes", key), key).alias("column_name"), c["value"].alias("value"))

    cells = F.coalesce(F.transform(F.filter("cells", lambda c: column_key(c["name"]) != ""), routed_cell), F.array().cast("array<struct<column_name:string,value:string>>"))
    placed = placed.select("meta_id", "table_name", "row_idx", F.coalesce("finals", F.array().cast("array<struct<column_name:string,family:string>>")).alias("finals"), cells.alias("cells"))
    unlisted = F.array_except(F.transform("cells", lambda c: c["column_name"]), F.transform("finals", lambda f: f["column_name"]))
    placed = placed.withColumn("finals", F.concat("finals", F.transform(unlisted, lambda n: F.struct(n.alias("column_name"), F.lit(None).cast("string").alias("family")))))
    told = placed.select("meta_id", "table_name", "row_idx", "cells", F.inline("finals"))
    mine = F.transform(F.filter("cells", lambda c: c["column_name"] == F.col("column_name")), lambda c: c["value"])
    values = F.when(F.size(mine) > 0, mine).otherwise(F.array(F.lit(None).cast("string")))
    out = told.select("meta_id", "table_name", "row_idx", "column_name", "family", F.posexplode(values).alias("value_no", "value"))
    cast = (
        F.when(F.col("family") == "whole number", F.regexp_replace("value", r"[,\s]", "").try_cast("bigint").cast("string"))
        .when(F.col("family") == "real number", F.regexp_replace("value", r"[,\s]", "").try_cast("double").cast("string"))
        .when(F.col("family") == "date or time", F.col("value").try_cast("timestamp_ntz").cast("string"))
        .otherwise(F.col("value"))
    )
    return out.select("meta_id", "table_name", "row_idx", "column_name", (F.col("value_no") + 1).alias("value_no"), "family", "value", cast.alias("value_cast"))
