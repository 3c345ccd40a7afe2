"""Where results go: one long table per stage, snapshots per run, and exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Stages in order; each writes its own snapshot (fixed values).
STAGES = ("RAW", "CLEANED", "CLASSIFIED", "REFINED", "ANALYZED")


def next_stage(path: str) -> str:
    """The path of the stage after the one that ``path`` ends in; the last and unknown ones raise."""
    for stage, after in zip(STAGES, STAGES[1:]):
        if path.rstrip("/").endswith(f"-{stage}"):
            return path.rstrip("/")[: -len(stage)] + after
    raise ValueError(f"no stage follows {path}")


def write_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> str:
    """Replaces a snapshot; ``partition_by`` should name columns of few values, such as a country."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return path


def create_table_as(df: DataFrame, name: str) -> None:
    """CREATE OR REPLACE TABLE … AS."""
    df.write.mode("overwrite").saveAsTable(name)


def export_csv(df: DataFrame, path: str) -> str:
    """One CSV file with a header, for a summary that people read."""
    df.coalesce(1).write.mode("overwrite").csv(path, header=True)
    return path


def promote(spark: SparkSession, source: str, target: str) -> str:
    """A stage's snapshot copied whole to another place."""
    spark.read.parquet(source).write.mode("overwrite").parquet(target)
    return target
