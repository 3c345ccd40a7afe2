"""All stages in a row, each writing its own snapshot and able to start from the one before."""

from __future__ import annotations

import os
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtab.functions.quantity import with_clean_quantity
from loomtab.functions.text import tidy_text
from loomtab.operators import classification, cleaning, mapping, refine, summary, taxonomy
from loomtab.schemas import CANONICAL_COLUMNS
from loomtab.sources import html
from loomtab.sources.files import last_wins
from loomtab.sources.sinks import STAGES, export_csv, write_table


@dataclass(frozen=True)
class Compat:
    """Choices where documented intent and observed behaviour of older runs differ."""

    collapse: str = "none"  # or "leaf": drop classes that are ancestors of other hits
    positional_halves: bool = True  # lay the halves of a double-wide table one under the other
    equipment_root: str = "Equipment"
    one_by_one: bool = False  # tables join their group in order, in place of rounds


class Pipeline:
    """Raw pages to summary. ``root`` is a shared folder; each stage lies in ``<root>/<run>-<STAGE>``."""

    def __init__(self, spark: SparkSession, root: str, run: str, nodes: DataFrame, rules: DataFrame, compat: Compat = Compat(), properties: DataFrame | None = None) -> None:
        self.spark, self.root, self.run_name, self.compat = spark, root, run, compat
        self.nodes, self.rules, self.paths = nodes, rules, taxonomy.paths(nodes)
        self.properties = properties  # entity, super_col of each class's properties, if there are any

    def path(self, stage: str, part: str) -> str:
        return os.path.join(self.root, f"{self.run_name}-{stage}", part)

    def _write(self, stage: str, part: str, df: DataFrame) -> DataFrame:
        return self.spark.read.parquet(write_table(df, self.path(stage, part)))

    def _read(self, stage: str, part: str) -> DataFrame:
        return self.spark.read.parquet(self.path(stage, part))

    def acquire(self, pages: DataFrame, at: datetime | None = None) -> None:
        """Tables of all pages, with the time of the scrape (``at``, or now); of equal keys the later page and table win."""
        rows = self._write("RAW", "extracted", html.wanted_tables(html.extract_tables(pages)))
        meta = rows.select(
            "table_name", "country", "url", "table_idx", F.col("h2").alias("section_h2"), F.col("h3").alias("section_h3"),
            F.col("h4").alias("section_h4"), "section_title", "page_id", "table_no",
        ).distinct()
        kept = last_wins(meta, "table_name", ("page_id", "table_no"))
        when = F.current_timestamp() if at is None else F.lit(at)
        self._write("RAW", "tables", kept.withColumn("scrape_timestamp", when.cast("timestamp_ntz")))
        body = rows.where("row_idx IS NOT NULL").join(kept.select("table_name", "page_id", "table_no"), ["table_name", "page_id", "table_no"], "left_semi")
        self._write("RAW", "rows", body.select("table_name", "row_idx", "cells"))

    def clean(self) -> None:
        rows = cleaning.clean_all(cleaning.compose_names(self._read("RAW", "rows")), tidy_text, self.compat.positional_halves)
        # names lose their table's country in rows and lists alike, so that they still meet
        cleaned = self._write("CLEANED", "rows", cleaning.strip_country(rows, self._read("RAW", "tables")))
        self._write("CLEANED", "columns", cleaning.column_list(cleaned))
        self._write("CLEANED", "tables", self._read("RAW", "tables").join(cleaned.select("table_name").distinct(), "table_name", "left_semi"))

    def classify(self) -> None:
        tables, columns = self._read("CLEANED", "tables"), self._read("CLEANED", "columns")
        class_rules = self.rules.where("kind = 'class'")
        headings = tables.select(F.explode(F.array(*classification.HEADINGS)).alias("text")).where("text IS NOT NULL AND text <> ''")
        naive = classification.classify_by_headings(tables, taxonomy.match_rules(headings, class_rules), self.paths, self.compat.equipment_root, self.compat.collapse)
        naive = self._write("CLASSIFIED", "by_headings", naive)
        features = classification.table_features(naive, columns, self.nodes, self.rules)
        groups = classification.starter_groups(self.nodes, self.paths, self.compat.equipment_root, self.rules)
        if self.compat.one_by_one:
            order = tables.select("table_name", F.struct("page_id", "table_no").alias("seq"))
            placed = classification.classify_in_order(naive, features, groups, order)
        else:
            placed = classification.classify_by_profile(naive, features, groups)
        classes = self._write("CLASSIFIED", "classes", placed)
        self._write("CLASSIFIED", "unclassified", classification.unclassified(classes))
        hits = taxonomy.match_rules(columns.select(F.col("column_name").alias("text")), self.rules)
        if self.properties is not None:
            hits = mapping.class_columns(hits, self.properties)
        mapped = self._write("CLASSIFIED", "mapping", mapping.classify_columns(columns, hits))
        self._write("CLASSIFIED", "report", mapping.mapping_report(classes, mapped))
        heads = tables.join(classes, "table_name", "left").select("table_name", "url", "country", "class_path", F.col("equipment_class").alias("sub_class"))
        master = mapping.build_master(self._read("CLEANED", "rows"), mapped, heads)
        self._write("CLASSIFIED", "master", master.withColumn("row_id", F.xxhash64("table_name", "row_idx")))

    def refine(self) -> None:
        master = self._read("CLASSIFIED", "master")
        fixed = refine.fix_classes(master, self.rules, self.paths, CANONICAL_COLUMNS, equipment=self.compat.equipment_root, collapse="leaf" if self.compat.collapse == "leaf" else "ancestor")
        done = self._write("REFINED", "canonical", with_clean_quantity(fixed))
        self._write("REFINED", "unknown", refine.unknown_contestants(done))

    def analyse(self) -> DataFrame:
        total = summary.summarise(self._read("REFINED", "canonical"), hidden=self.compat.equipment_root)
        out = self._write("ANALYZED", "summary", total.orderBy(*summary.SUMMARY_KEYS))
        export_csv(out, self.path("ANALYZED", "summary_csv"))
        return out

    def run(self, pages: DataFrame | None = None, from_stage: str = "RAW") -> DataFrame:
        """Runs from a stage on; earlier stages are read as an earlier run left them."""
        if from_stage not in STAGES:
            raise ValueError(f"unknown stage {from_stage}")
        steps = {"RAW": lambda: self.acquire(pages), "CLEANED": self.clean, "CLASSIFIED": self.classify, "REFINED": self.refine}
        for stage in STAGES[STAGES.index(from_stage) : -1]:
            steps[stage]()
        return self.analyse()
