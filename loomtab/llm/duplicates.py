"""Exact duplicates hidden by formatting: range partition, external sort, scan of adjacent runs."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtab.llm.fold import letters_and_digits
from loomtab.session import cut_lineage

_SEP = "\u0001"
_SCAN = "kind tinyint, pid int, row_id bigint, first_local bigint, n bigint, head boolean, tail boolean, record string"
_SCHEMA = pa.schema(
    [
        ("kind", pa.int8()), ("pid", pa.int32()), ("row_id", pa.int64()), ("first_local", pa.int64()),
        ("n", pa.int64()), ("head", pa.bool_()), ("tail", pa.bool_()), ("record", pa.string()),
    ]
)
ROW, RUN = 0, 1


def canonical_records(rows: DataFrame, fields: Sequence[str], group: Sequence[str] = (), id_: str = "row_id", part: str = ";") -> DataFrame:
    """``row_id, record``: the whole canonical text of each row that states a record.

    Values are the parts of all ``fields`` together, as a set: order, field and
    repeats within a row don't matter. A value is its letters (with accents)
    and digits in lower case; values without any are none. Rows without values
    are no records, nor are rows without an id. ``group`` columns are compared as they are; NULL is a group.
    """
    parts = F.flatten(F.array(*[F.split(F.coalesce(F.col(f), F.lit("")), part) for f in fields]))
    values = F.array_sort(F.array_distinct(F.filter(F.transform(parts, letters_and_digits), lambda v: v != "")))
    where = [F.coalesce(F.concat(F.lit("="), F.col(g).cast("string")), F.lit("")) for g in group]
    keyed = rows.select(F.col(id_).alias("row_id"), F.array(*where).cast("array<string>").alias("g"), values.alias("values"))
    return keyed.where((F.size("values") > 0) & F.col("row_id").isNotNull()).select("row_id", F.array_join(F.concat("g", "values"), _SEP).alias("record"))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One pass over sorted (record, row_id). Memory: one batch and the open run's key."""
    from pyspark import TaskContext

    pid = TaskContext.get().partitionId()
    open_key, open_first, open_n, in_head = None, 0, 0, True

    def out(kind: int, ids, firsts, ns, head, tail, keys) -> pa.RecordBatch:
        k = len(firsts)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(k, kind, np.int8)), pa.array(np.full(k, pid, np.int32)), ids if ids is not None else pa.nulls(k, pa.int64()), pa.array(firsts, pa.int64()),
                pa.array(ns, pa.int64()) if ns is not None else pa.nulls(k, pa.int64()), pa.array(head, pa.bool_()), pa.array(tail, pa.bool_()), keys if keys is not None else pa.nulls(k, pa.string()),
            ],
            schema=_SCHEMA,
        )

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        keys, ids = batch.column("record").cast(pa.string()), batch.column("row_id").to_numpy(zero_copy_only=False)
        new = np.ones(n, bool)
        new[0] = open_key is None or keys[0].as_py() != open_key
        if n > 1:
            new[1:] = pc.not_equal(keys.slice(1), keys.slice(0, n - 1)).to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(new)
        # the run of each row: 0 is the one left open by the batch before
        run = np.cumsum(new)
        firsts = np.concatenate(([open_first], ids[starts]))[run]
        heads = (run == 0) & in_head if open_key is not None else (run == 1)
        keep = np.flatnonzero(heads | (firsts != ids))
        if len(keep):
            yield out(ROW, pa.array(ids[keep]), firsts[keep], None, heads[keep], np.zeros(len(keep), bool), None)
        # runs that end here: the open one if a new one starts, and all that start here but the last
        sizes = np.bincount(run, minlength=len(starts) + 1)
        sizes[0] += open_n
        first_of = np.concatenate(([open_first], ids[starts]))
        done = np.arange(0 if open_key is not None else 1, len(starts))
        if len(done):
            head = (done == done[0]) & in_head
            ended = [(open_key if i == 0 else keys[int(starts[i - 1])].as_py()) if h else None for i, h in zip(done[:1], head[:1])]
            yield out(RUN, None, first_of[done], sizes[done], head, np.zeros(len(done), bool), pa.array(ended + [None] * (len(done) - 1), pa.string()))
            in_head = False
        if len(starts):
            open_key, open_first = keys[int(starts[-1])].as_py(), int(ids[starts[-1]])
        open_n = int(sizes[-1])
    if open_key is not None:
        yield out(RUN, None, [open_first], [open_n], [in_head], [True], pa.array([open_key], pa.string()))


class DuplicateRuns:
    """The scanned runs of equal records; both results come from one scan.

    Records are range-partitioned and sorted by (record, row_id), so a record
    that holds a third of all rows spreads over several partitions. Whole keys
    are compared, never hashes. Only the first and the last run of a partition
    can go on in another one: those at most two runs per partition are joined
    by key afterwards. The scan is checkpointed, as ranges of a second run may
    differ.

    A repeated ``row_id`` counts as often as it stands. Empty input gives empty
    results.
    """

    def __init__(self, records: DataFrame) -> None:
        placed = records.select("record", "row_id").repartitionByRange("record", "row_id").sortWithinPartitions("record", "row_id")
        self.scan = cut_lineage(placed.mapInArrow(_scan, _SCAN))
        edges = self.scan.where((F.col("kind") == RUN) & (F.col("head") | F.col("tail")))
        whole = edges.groupBy("record").agg(F.min("first_local").alias("first_row_id"))
        #: At most one row per partition of the scan, which is the proven bound of its broadcast.
        self.heads = edges.where("head").join(whole, "record").select("pid", F.col("first_row_id").alias("head_first"))

    def _with_first(self, part: DataFrame) -> DataFrame:
        joined = part.join(F.broadcast(self.heads), "pid", "left")
        return joined.withColumn("first_row_id", F.when(F.col("head"), F.col("head_first")).otherwise(F.col("first_local")))

    def copies(self) -> DataFrame:
        """``first_row_id, row_id`` of each row of a record other than its first."""
        rows = self._with_first(self.scan.where(F.col("kind") == ROW))
        return rows.where("row_id <> first_row_id").select("first_row_id", "row_id")

    def representatives(self) -> DataFrame:
        """``first_row_id, n_copies`` of each record; the count covers all its rows."""
        runs = self._with_first(self.scan.where(F.col("kind") == RUN))
        inner = runs.where("NOT head AND NOT tail").select("first_row_id", F.col("n").alias("n_copies"))
        outer = runs.where("head OR tail").groupBy("first_row_id").agg(F.sum("n").alias("n_copies"))
        return inner.unionByName(outer)
