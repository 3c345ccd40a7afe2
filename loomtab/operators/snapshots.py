"""Consecutive full snapshots: their order, and what changed between them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Stands for the key itself among the fields of a cell; raw fields can't be named so.
PRESENCE = "\u0001present"


def snapshot_chain(meta: DataFrame, table: str = "table_name", at: str = "scrape_timestamp", id_: str = "meta_id") -> DataFrame:
    """``meta_id, snapshot_id, prev_id, next_id, n_deliveries`` (and table, time) of each delivery.

    Deliveries with the same table and time are one snapshot, known by its
    smallest id; snapshots of a table follow one another by time. A delivery
    without table or time belongs to none and is left out, as the order is then
    unknown; repeated ids count once.

    The neighbours are found within a day first and across days second, so no
    task holds the whole history of one much scraped table.
    """
    deliveries = meta.select(F.col(id_).alias("meta_id"), F.col(table).alias("table_name"), F.col(at).alias("at"))
    deliveries = deliveries.where("meta_id IS NOT NULL AND table_name IS NOT NULL AND at IS NOT NULL")
    snaps = deliveries.groupBy("table_name", "at").agg(F.min("meta_id").alias("snapshot_id"), F.count(F.lit(1)).alias("n_deliveries"))
    snaps = snaps.withColumn("day", F.to_date("at"))
    by_day = W.partitionBy("table_name", "day").orderBy("at")
    snaps = snaps.withColumn("prev_in", F.lag("snapshot_id").over(by_day)).withColumn("next_in", F.lead("snapshot_id").over(by_day))
    days = snaps.groupBy("table_name", "day").agg(
        F.min_by("snapshot_id", "at").alias("first_id"), F.max_by("snapshot_id", "at").alias("last_id")
    )
    over = W.partitionBy("table_name").orderBy("day")
    days = days.select(
        "table_name", "day", F.lag("last_id").over(over).alias("prev_out"), F.lead("first_id").over(over).alias("next_out")
    )
    chain = snaps.join(days, ["table_name", "day"]).select(
        "table_name",
        "at",
        "snapshot_id",
        F.coalesce("prev_in", "prev_out").alias("prev_id"),
        F.coalesce("next_in", "next_out").alias("next_id"),
        "n_deliveries",
    )
    return deliveries.join(chain, ["table_name", "at"]).distinct()


def latest_items(rows: DataFrame, chain: DataFrame, key: Sequence[str], fields: Sequence[str], version: str) -> DataFrame:
    """One row per snapshot and key: of repeated rows the one with the largest ``version`` holds."""
    held = rows.select(F.col("meta_id"), *key, F.col(version).alias("__v"), F.struct(*fields).alias("__f"))
    for k in key:
        held = held.where(F.col(k).isNotNull())
    placed = held.join(chain.select("meta_id", "snapshot_id", "prev_id", "next_id"), "meta_id")
    last = placed.groupBy("snapshot_id", *key).agg(
        F.max_by("__f", "__v").alias("__f"), F.first("prev_id").alias("prev_id"), F.first("next_id").alias("next_id")
    )
    return last.select("snapshot_id", "prev_id", "next_id", *key, "__f.*")


def snapshot_changes(
    rows: DataFrame, meta: DataFrame, key: Sequence[str] = ("item_no",), fields: Sequence[str] = ("quantity_clean",), version: str = "row_id"
) -> DataFrame:
    """``meta_id, <key>, change_kind, changed_fields`` between consecutive snapshots of a table.

    Each snapshot is unpivoted into cells (key, field, value) and one presence
    marker per key. A cell counts +1 in its own snapshot and -1 in the next
    one; sums that are not zero are the differences. A presence of +1 is
    ``added``, of -1 ``removed``; other differences make the key ``changed``
    and name its fields. NULL values differ from all others and equal NULL.

    The first snapshot of a table has no changes; one without items is still a
    snapshot. Rows without a key value, or of a delivery that is not in
    ``meta``, belong to no snapshot. ``meta_id`` is the later snapshot's. Exact
    repeats and overruled rows count once. Empty inputs give an empty result.
    """
    items = latest_items(rows, snapshot_chain(meta), key, fields, version)
    values = [
        F.struct(F.lit(f).alias("field"), F.coalesce(F.concat(F.lit("="), F.col(f).cast("string")), F.lit("NULL")).alias("value"))
        for f in fields
    ]
    cells = F.array(F.struct(F.lit(PRESENCE).alias("field"), F.lit("").alias("value")), *values)
    signs = F.filter(
        F.array(
            F.struct(F.when(F.col("prev_id").isNotNull(), F.col("snapshot_id")).alias("in_id"), F.lit(1).alias("sign")),
            F.struct(F.col("next_id").alias("in_id"), F.lit(-1).alias("sign")),
        ),
        lambda s: s["in_id"].isNotNull(),
    )
    # placed once by snapshot and key, before unpivoting: both sums below keep that placing
    placed = items.select(*key, *fields, F.inline(signs)).repartition("in_id", *key)
    signed = placed.select("in_id", *key, "sign", F.inline(cells))
    nonzero = signed.groupBy("in_id", *key, "field", "value").agg(F.sum("sign").alias("sign")).where("sign <> 0")
    kinds = nonzero.groupBy("in_id", *key).agg(
        F.sum(F.when(F.col("field") == PRESENCE, F.col("sign")).otherwise(0)).alias("presence"),
        F.array_sort(F.collect_set(F.when(F.col("field") != PRESENCE, F.col("field")))).alias("changed_fields"),
    )
    kind: Column = F.when(F.col("presence") > 0, "added").when(F.col("presence") < 0, "removed").otherwise("changed")
    return kinds.select(
        F.col("in_id").alias("meta_id"),
        *key,
        kind.alias("change_kind"),
        F.when(F.col("presence") == 0, F.col("changed_fields")).otherwise(F.array().cast("array<string>")).alias("changed_fields"),
    )
