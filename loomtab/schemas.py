"""Fixed column lists and schemas of the canonical model."""

from __future__ import annotations

from pyspark.sql import types as T

#: Canonical columns in their fixed order (fixed values).
CANONICAL_COLUMNS = (
    "country", "quantity", "origin", "cost", "dates", "status", "class_path", "sub_class", "role", "capability",
    "propulsion", "equip_type", "other_names", "variant", "ship_name", "dimensions", "weight", "displacement",
    "width", "caliber", "length", "range", "speed", "armament", "carrier", "note",
)

#: Fields of the mapping report that list raw columns; ``country`` holds the country itself.
MAPPED_FIELDS = tuple(c for c in CANONICAL_COLUMNS if c != "country")

CELLS = T.ArrayType(T.StructType([T.StructField("pos", T.IntegerType()), T.StructField("name", T.StringType()), T.StructField("value", T.StringType())]))
#: Rows of all tables in the long form.
RAW_ROWS = T.StructType([T.StructField("table_name", T.StringType()), T.StructField("row_idx", T.IntegerType()), T.StructField("cells", CELLS)])
#: The catalogue of tables.
TABLES_META = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("table_idx", T.IntegerType()),
        T.StructField("section_h2", T.StringType()),
        T.StructField("section_h3", T.StringType()),
        T.StructField("section_h4", T.StringType()),
        T.StructField("section_title", T.StringType()),
        T.StructField("scrape_timestamp", T.TimestampNTZType()),
    ]
)
