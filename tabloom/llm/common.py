"""Shared pieces of the corpus operators: keys, word hashes, row groups, scratch tables.

Conventions of all operators here: a null text is an empty text; a null id is a
value of its own, larger than every other id (``NULL_ID`` inside the
operators, null again in results); extra columns travel inside one struct, so
their names cannot clash with working columns.
"""

from __future__ import annotations

import gc
import os
import time
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.session import materialize, scratch_path  # noqa: F401

NULL_ID = (1 << 63) - 1
WORD_GAP = b" \t\n\x0b\x0c\r"  # what bytes.split() splits at
_CACHED_WORDS = 400_000
_CLEANING = 0.25  # seconds

def id_key(name: str) -> Column:
    """The id as a long that is never null."""
    return F.coalesce(F.col(name).cast("long"), F.lit(NULL_ID))


def id_value(key: Column | str) -> Column:
    """The inverse of ``id_key``."""
    return F.nullif(F.col(key) if isinstance(key, str) else key, F.lit(NULL_ID))


def on_workers(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver did.

    For local use; where that folder does not exist, workers need it installed
    or passed with ``--py-files``.
    """
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in paths.split(os.pathsep):
        joined = os.pathsep.join(filter(None, [paths, root]))
        spark.sparkContext.environment["PYTHONPATH"] = joined
    return spark


def release(spark: SparkSession) -> None:
    """Let Spark delete shuffle files of jobs whose results are already stored.

    Spark removes them once the driver has collected the plans that made them,
    in a thread of its own, which gets a moment here.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    time.sleep(_CLEANING)


class Scratch:
    """Stored steps of one job, which can be dropped once nothing reads them."""

    def __init__(self, spark: SparkSession, compression: str = "snappy"):
        self.spark, self.compression = spark, compression
        self._paths: dict[str, str] = {}

    def store(self, df: DataFrame, label: str) -> DataFrame:
        """Write ``df`` to the shared folder and return a scan of it (an action)."""
        path = self._paths[label] = scratch_path(self.spark, label)
        df.write.option("compression", self.compression).parquet(path)
        release(self.spark)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *labels: str) -> None:
        for label in labels:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self._paths.pop(label))
            conf = self.spark._jsc.hadoopConfiguration()
            path.getFileSystem(conf).delete(path, True)


def partitions(rows: int, per_task: int, spark: SparkSession) -> int:
    """Tasks for ``rows``: by size, but not fewer than the cores while rows last."""
    cores = spark.sparkContext.defaultParallelism
    return max(1, -(-rows // per_task), min(cores, -(-rows // 500)))


class WordHashes(dict):
    """XXH64 of words as unsigned integers; forgets all once it has grown large."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > _CACHED_WORDS:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_FINISH = np.uint64(0xD6E8FEB86659FD93)
_HALF = np.uint64(32)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _HALF)) * _FINISH
    return x ^ (x >> _HALF)


def gram_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash for every run of ``size`` consecutive items."""
    count = len(hashes) - size + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    out = hashes[:count].copy()
    for shift in range(1, size):
        out *= _MULTIPLIER
        out += hashes[shift : shift + count]
    return mix(out)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by doubling."""
    have = 1
    while have < width:
        step = min(have, width - have)
        values = np.minimum(values[:-step], values[step:])
        have += step
    return values


def binary(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8 bytes; a null text is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def sorted_groups(
    batches: Iterator[pa.RecordBatch], keys: list[str], least: int = 1
) -> Iterator[pa.Table]:
    """One table per run of ``least`` or more equal keys, in batches sorted by them."""
    rest: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table])
        starts = _run_starts(table, keys)
        sizes = np.diff(starts)
        for i in np.flatnonzero(sizes >= least):
            yield table.slice(starts[i], sizes[i])
        rest = table.slice(starts[-1])
    if rest is not None and rest.num_rows >= least:
        yield rest


def whole_groups(
    batches: Iterator[pa.RecordBatch], keys: list[str]
) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole runs of equal keys, with each run's begin, in sorted batches."""
    rest: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table])
        starts = _run_starts(table, keys)
        if len(starts) > 1:
            yield table.slice(0, starts[-1]), starts[:-1]
        rest = table.slice(starts[-1])
    if rest is not None:
        yield rest, np.zeros(1, np.int64)


def _run_starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    change = np.zeros(table.num_rows, bool)
    change[0] = True
    for key in keys:
        values = table.column(key).to_numpy()
        change[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(change)


def local_components(size: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest position reachable from each position by the links a-b."""
    label = np.arange(size)
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def forest_edges(size: int, a: np.ndarray, b: np.ndarray, names: np.ndarray):
    """Links that connect what the given links connect, at most one per position."""
    label = local_components(size, a, b)
    moved = np.flatnonzero(label != np.arange(size))
    return pa.RecordBatch.from_arrays(
        [pa.array(names[moved], pa.int64()), pa.array(names[label[moved]], pa.int64())],
        ["a", "b"],
    )


def in_chunk_pairs(rows: DataFrame, key: str, row_id: str, chunk: int) -> DataFrame:
    """Lay out rows so that every two rows of a key meet in one bounded block.

    Keys with up to ``chunk`` rows form one block. A larger one is cut into
    chunks by a hash of ``row_id``, and every pair of chunks is a block of its
    own, so that a key of any size is spread over many tasks. Adds ``part``
    (the row's chunk), ``lo`` and ``hi`` (the block's chunks); rows are
    distributed and sorted by block.
    """
    large = (
        rows.groupBy(key)
        .count()
        .where(F.col("count") > chunk)
        .select(key, F.ceil(F.col("count") / (chunk // 2)).cast("int").alias("chunks"))
    )
    placed = rows.join(large, key, "left").withColumn(
        "part",
        F.when(
            F.col("chunks").isNotNull(),
            F.pmod(F.xxhash64(row_id), F.col("chunks")).cast("int"),
        ).otherwise(F.lit(0)),
    )
    other = F.explode(
        F.when(
            F.col("chunks").isNotNull(), F.sequence(F.lit(0), F.col("chunks") - 1)
        ).otherwise(F.array(F.lit(0)))
    )
    blocks = placed.withColumn("other", other).withColumns(
        {"lo": F.least("part", "other"), "hi": F.greatest("part", "other")}
    )
    return (
        blocks.drop("chunks", "other")
        .repartition(key, "lo", "hi")
        .sortWithinPartitions(key, "lo", "hi")
    )
