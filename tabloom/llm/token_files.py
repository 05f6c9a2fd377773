"""Token ids in Arrow files: equal-length sequences and masks, read without copying.

A shard is one Arrow file (IPC file format) with two fixed-size-list columns:
``ids`` (unsigned 16 bits when the vocabulary fits, else 32) and ``mask`` (true
on real tokens). Ids of the shard's documents follow each other without gaps;
the last sequence is padded with zeros under a false mask. Every record batch
holds ``BATCH`` sequences, the last one fewer, so sequence i is row ``i %
BATCH`` of batch ``i // BATCH``: a reader maps the file and slices.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabloom.llm import bpe
from tabloom.llm.common import id_key, id_value, sorted_groups
from tabloom.session import materialize, scratch_path

BATCH = 256
_SHARD_BYTES = 32 << 20  # of text


def open_folder(path: str) -> tuple[pafs.FileSystem, str]:
    """Arrow's file system for a folder named by a URI or a local path."""
    return pafs.FileSystem.from_uri(path)


class ShardWriter:
    """Appends ids to one shard file, a record batch at a time."""

    def __init__(self, folder: str, name: str, length: int, vocabulary: int):
        files, root = open_folder(folder)
        files.create_dir(root, recursive=True)
        self.path = f"{folder.rstrip('/')}/{name}"
        self.length, self.tokens = length, 0
        self.dtype = np.dtype("<u2" if vocabulary <= 1 << 16 else "<u4")
        kind = pa.uint16() if self.dtype.itemsize == 2 else pa.uint32()
        self.schema = pa.schema(
            [("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length))]
        )
        self._sink = files.open_output_stream(f"{root.rstrip('/')}/{name}")
        self._writer = pa.ipc.new_file(self._sink, self.schema)
        self._waiting: list[np.ndarray] = []
        self._count = 0

    def add(self, ids: np.ndarray) -> None:
        self._waiting.append(ids.astype(self.dtype))
        self._count += len(ids)
        self.tokens += len(ids)
        if self._count >= BATCH * self.length:
            ids = np.concatenate(self._waiting)
            whole = len(ids) // (BATCH * self.length) * BATCH * self.length
            for begin in range(0, whole, BATCH * self.length):
                self._write(ids[begin : begin + BATCH * self.length])
            self._waiting, self._count = [ids[whole:]], len(ids) - whole

    def _write(self, ids: np.ndarray) -> None:
        rows = -(-len(ids) // self.length)
        padded = np.zeros(rows * self.length, self.dtype)
        padded[: len(ids)] = ids
        mask = np.arange(len(padded)) < len(ids)
        columns = [
            pa.FixedSizeListArray.from_arrays(pa.array(x), self.length)
            for x in (padded, mask)
        ]
        self._writer.write_batch(
            pa.RecordBatch.from_arrays(columns, schema=self.schema)
        )

    def close(self) -> None:
        if self._count:
            self._write(np.concatenate(self._waiting))
        self._writer.close()
        self._sink.close()


class ShardReader:
    """Random access to a shard; local files are mapped, never copied."""

    def __init__(self, path: str):
        files, inner = open_folder(path)
        local = isinstance(files, pafs.LocalFileSystem)
        source = pa.memory_map(inner) if local else files.open_input_file(inner)
        self._file = pa.ipc.open_file(source)
        self.length = self._file.schema.field("ids").type.list_size
        self._at: tuple[int, np.ndarray] = (-1, np.empty(0))

    def _batch(self, i: int, column: str) -> pa.FixedSizeListArray:
        return self._file.get_batch(i).column(column)

    def sequence(self, i: int) -> np.ndarray:
        """A view of the ids of sequence ``i``, padding included."""
        return self._batch(i // BATCH, "ids")[i % BATCH].values.to_numpy()

    def mask(self, i: int) -> np.ndarray:
        """True on the tokens of sequence ``i``, false on its padding."""
        values = self._batch(i // BATCH, "mask")[i % BATCH].values
        return values.to_numpy(zero_copy_only=False)

    def tokens(self, begin: int, end: int) -> np.ndarray:
        """Ids from ``begin`` to before ``end`` of the shard; a view within a batch."""
        size, parts = BATCH * self.length, []
        while begin < end:
            i, offset = divmod(begin, size)
            if self._at[0] != i:
                self._at = (i, self._batch(i, "ids").flatten().to_numpy())
            parts.append(self._at[1][offset : offset + end - begin])
            begin += len(parts[-1])
        if not parts:
            return np.empty(0, np.uint32)
        return parts[0] if len(parts) == 1 else np.concatenate(parts)


def write_tokens(
    docs: DataFrame,
    tokenizer_path: str,
    folder: str,
    end_id: int,
    length: int = 2048,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Encode whole texts, append ``end_id`` to each, write shards in id order.

    Returns the stored index, one row per document: ``key`` (see ``id_key``),
    ``shard``, ``path``, ``start`` (ids of all documents before it in the whole
    table), ``begin`` (the same within its shard) and ``n_tokens`` (with the end
    id). Shards are ranges of ids; only a shard's last sequence is padded. A
    null or empty text is the end id alone; null ids come last; rows that repeat
    an id are all written, by text order; an empty table writes no file.

    A task writes a file of a new name, and the index names the files of
    tasks that succeeded: a repeated task cannot damage a shard.
    """
    spark = docs.sparkSession
    schema = "key long, shard int, path string, begin long, n_tokens long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe.from_json(tokenizer_path)
        vocabulary = max(encoder.tokenizer.get_vocab_size(), end_id + 1)
        shard = TaskContext.get().partitionId()
        writer: ShardWriter | None = None
        for batch in batches:
            if batch.num_rows and writer is None:
                name = f"shard-{shard:05d}-{uuid.uuid4().hex}.arrow"
                writer = ShardWriter(folder, name, length, vocabulary)
            at = 0
            for ids, ends in encoder.batches(batch.column("text")):
                before = writer.tokens
                writer.add(np.insert(ids, ends, end_id))
                closed = before + ends + np.arange(1, len(ends) + 1)
                begins = np.concatenate([[before], closed[:-1]])
                size = len(ends)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("key").slice(at, size),
                        pa.array(np.full(size, shard, np.int32)),
                        pa.array([writer.path] * size),
                        pa.array(begins),
                        pa.array(closed - begins),
                    ],
                    ["key", "shard", "path", "begin", "n_tokens"],
                )
                at += size
        if writer is not None:
            writer.close()

    rows = docs.select(id_key(id_column).alias("key"), F.col(text_column).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, -(-size // _SHARD_BYTES))
    index = materialize(
        rows.repartitionByRange(count, "key", F.xxhash64("text"))
        .sortWithinPartitions("key", "text")
        .mapInArrow(run, schema),
        "token-index",
    )
    totals = index.groupBy("shard").agg(F.sum("n_tokens").alias("total"))
    before = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    base = totals.select(  # a row per shard
        "shard", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base")
    )
    return index.join(base, "shard").select(
        "key", "shard", "path", (F.col("base") + F.col("begin")).alias("start"),
        "begin", "n_tokens",
    )


def read_tokens(index: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Every document's ids, read back from the shards.

    Takes what ``write_tokens`` returned; returns ``id_column``, ``start``,
    ``n_tokens`` and ``ids`` (binary: little-endian unsigned 32-bit).
    """
    schema = "key long, start long, n_tokens long, ids binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["shard"]):
            reader = ShardReader(group.column("path")[0].as_py())
            for begin in range(0, group.num_rows, 1000):
                part = group.slice(begin, 1000)
                spans = zip(
                    part.column("begin").to_pylist(),
                    part.column("n_tokens").to_pylist(),
                    strict=True,
                )
                ids = [reader.tokens(b, b + n).astype("<u4").tobytes() for b, n in spans]
                yield from part.select(["key", "start", "n_tokens"]).append_column(
                    "ids", pa.array(ids, pa.binary())
                ).combine_chunks().to_batches()

    placed = index.repartition("shard").sortWithinPartitions("shard", "begin")
    return placed.mapInArrow(run, schema).select(
        id_value("key").alias(id_column), "start", "n_tokens", "ids"
    )


def shard_folder(spark: SparkSession) -> str:
    """A fresh folder for shards below the cluster's shared folder."""
    return scratch_path(spark, "tokens")
