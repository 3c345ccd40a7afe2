"""Sizes written in many units, converted to one unit per field."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtab.functions import units as U


def _by_field(fields: tuple[U.Field, ...], of) -> Column:
    """CASE over ``field_name``."""
    case = F
    for f in fields:
        case = case.when(F.col("field_name") == f.name, of(f))
    return case


def harmonise_measures(rows: DataFrame, mapping: DataFrame, fields: tuple[U.Field, ...] = U.FIELDS) -> DataFrame:
    """``row_id, field_name, unit, value_milli`` of each cell that states one size with a known unit.

    The unit comes from the cell, else from the row's note, else from the raw
    column name of the scrape. The unit text is looked up by an equi-join with
    the composed conversions (a fixed number of rows, so it is broadcast), and
    ``value_milli`` is the value in the target unit times 1000, rounded half up.

    NULL, empty and unreadable cells, spans, Mach numbers and numbers without a
    unit give no row; so do numbers beyond 12 digits before the decimal mark.
    Repeated ``row_id`` give repeated rows. Other columns of ``rows`` don't
    matter. Where a scrape stands more than once in ``mapping``, the smallest
    text holds. Empty inputs give an empty result.
    """
    named = mapping.groupBy("meta_id").agg(*[F.min(f.name).alias(f"from_{f.name}") for f in fields])
    known = named.select("meta_id", *[U.column_unit(f, F.col(f"from_{f.name}")).alias(f"unit_{f.name}") for f in fields])
    r = rows.select("row_id", "meta_id", "note", *[f.name for f in fields])
    some = None
    for f in fields:
        some = F.col(f.name).isNotNull() if some is None else some | F.col(f.name).isNotNull()
    joined = r.where(some).join(known, "meta_id", "left")
    cells = joined.select(
        "row_id",
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(f.name).alias("field_name"),
                        F.col(f.name).alias("cell"),
                        F.col("note"),
                        F.col(f"unit_{f.name}").alias("named"),
                    )
                    for f in fields
                ]
            )
        ),
    ).where("cell IS NOT NULL")
    texts = cells.select("row_id", "field_name", U.tidy(F.col("cell")).alias("text"), U.tidy(F.col("note")).alias("note"), "named")
    found = texts.select("*", U.let(F.col("text"), lambda t: _by_field(fields, lambda f: U.match_size(f, t))).alias("hit"))
    # with a unit: before, number, unit, after; without: before, number, after
    hits = found.withColumn("hit", F.when(F.size("hit") < 4, U.let(F.col("text"), U.match_bare)).otherwise(F.col("hit")))
    part = lambda i: F.get(F.col("hit"), F.lit(i))
    sized = hits.where(F.size("hit") >= 3).select(
        "row_id", "field_name", "text", "note", "named", part(0).alias("before"), part(1).alias("number"),
        F.when(F.size("hit") == 4, part(2)).otherwise("").alias("unit"), F.element_at("hit", -1).alias("after"),
    )
    single = sized.where(
        ~(F.col("unit") != "") | ~U.span_before(F.col("before"))
    ).where(
        ~U.span_after(F.col("after")) & ~_by_field(fields, lambda f: U.not_of_field(f, F.col("text"), F.col("number"), F.col("unit")))
    )
    read = single.select(
        "row_id",
        "field_name",
        F.coalesce(
            F.nullif(U.unit_text(F.col("unit")), F.lit("")), U.let(F.col("note"), lambda n: _by_field(fields, lambda f: U.note_unit(f, n))), "named"
        ).alias("unit_text"),
        "number",
        U.let(F.col("after"), lambda a: _by_field(fields, lambda f: U.inches_after(f, F.col("unit"), a))).alias("inches"),
    )
    typed = read.select("row_id", "field_name", "unit_text", U.number_value(F.col("number")).alias("value"), U.number_value(F.col("inches")).alias("inches"))
    table = U.conversions(rows.sparkSession, fields)
    inch = table.where("unit = 'inch'").groupBy("field_name").agg(F.first("scale").alias("inch_scale"))
    out = typed.join(F.broadcast(table), ["field_name", "unit_text"]).join(F.broadcast(inch), "field_name", "left")
    milli = F.col("value") * (F.col("scale") * 1000).cast("decimal(19,9)")
    more = F.coalesce(F.col("inches") * (F.col("inch_scale") * 1000).cast("decimal(19,9)"), F.lit(0).cast("decimal(38,15)"))
    shift = (F.col("offset") * 1000).cast("decimal(19,9)")
    return out.select(
        "row_id", "field_name", "unit", F.round(milli + more + shift, 0).try_cast("bigint").alias("value_milli")
    ).where("value_milli IS NOT NULL")
