"""Token ids of whole texts by a public byte-level vocabulary."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from typing import TYPE_CHECKING

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

if TYPE_CHECKING:
    from loomtab.llm.bpe import Bpe

#: Where the public vocabulary files lie; a parameter of every operator here.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"


def _sent(spark, path: str) -> Callable[[], Bpe]:
    """Sends the vocabulary file to all executors once; gives what loads it there, or here if a worker has it not."""
    spark.sparkContext.addFile(path)
    name = os.path.basename(path)

    def load_sent() -> Bpe:
        from pyspark import SparkFiles

        from loomtab.llm.bpe import load

        here = SparkFiles.get(name)
        return load(here if os.path.exists(here) else path)

    return load_sent


def encode_corpus(docs: DataFrame, path: str = VOCABULARY, id_: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, ids``: the token ids of each whole text, without special tokens.

    Special tokens' strings in a text are ordinary text. NULL and empty texts
    have an empty list. Rows map one to one, so repeated ids and texts repeat;
    no shuffle takes place. Very long texts pass through the encoder in pieces
    of constant size; only their ids grow with them.
    """
    held = _sent(docs.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = held()
        for batch in batches:
            texts = batch.column(1)
            for at in range(0, batch.num_rows, 256):  # so that long texts don't pile up their ids
                ids = [bpe.encode(t.as_py()) for t in texts.slice(at, 256)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, 256), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    kind = docs.schema[id_].dataType.simpleString()
    return docs.select(F.col(id_).alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, ids array<int>")


def count_tokens(docs: DataFrame, keep: tuple[str, ...] = (), path: str = VOCABULARY, id_: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, <keep>, n_tokens`` of each document; 0 for NULL and empty texts."""
    held = _sent(docs.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = held()
        for batch in batches:
            n = pa.array([len(bpe.encode(t.as_py())) for t in batch.column(batch.num_columns - 1)], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], n], [*batch.schema.names[:-1], "n_tokens"])

    chosen = docs.select(F.col(id_).alias("doc_id"), *keep, F.col(text).cast("string").alias("__text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[:-1])
    return chosen.mapInArrow(run, f"{fields}, n_tokens bigint")


def decode_corpus(encoded: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """``doc_id, text`` of each list of ids, byte by byte through the incremental decoder; a NULL list gives NULL."""
    held = _sent(encoded.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = held()
        for batch in batches:
            texts = [None if (ids := v.as_py()) is None else bpe.decode(ids) for v in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")
