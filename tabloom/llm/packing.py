"""Lexical retrieval packing: fill a seed document's window with its BM25 neighbours."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm import bpe
from tabloom.llm.common import id_key, id_value, materialize

SHARD = 1024  # documents per inverted index
_SHARDS_PER_TASK = 16
_K1, _B = 1.2, 0.75
_REINDEX = 0.9  # share of an index's documents left when the others are dropped

_PIECE = (
    "key long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int,
    window: int = 1024,
    id_column: str = "doc_id",
    text_column: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Pack all whole texts into sequences of at most ``window`` tokens.

    A document is its ids and ``end_id``. As many whole windows as it has
    tokens for become sequences of their own; the tokens after them, its open
    end, wait to be packed (so a short document is packed whole). Open ends
    are sorted by a lexical sketch and cut into shards of ``SHARD``; a shard
    has an inverted index with BM25 weights, whose document frequencies and
    mean length are those of all open ends. The first unused one of a shard is
    the seed of a sequence; unused neighbours follow by falling score until the
    window is full. One that is too long is cut, and its rest is unused again.
    Only the last sequence of a shard can be short; it is padded.

    Returns a row per piece: ``id_column``, ``start`` and ``length`` (tokens of
    the document), ``ids_crc32`` (of its ids as little-endian unsigned 32-bit
    integers), ``doc_tokens``, ``sequence_id`` and ``offset`` (tokens before it
    there); with ``with_ids`` also ``ids`` (binary) of it.

    A null or empty text is its end id alone. Null ids stay null; rows that
    repeat an id are packed each; an empty table gives an empty table; other
    columns are left out.
    """
    rows = docs.select(id_key(id_column).alias("key"), F.col(text_column).alias("text"))
    encoded = materialize(
        rows.mapInArrow(
            lambda batches: _encode(
                batches, tokenizer_path, end_id, window, with_ids
            ),
            _ENCODED,
        ).withColumn("sequence_id", 2 * F.monotonically_increasing_id() + 1),
        "packing-encoded",
    )
    whole = encoded.where("sketch is null").drop("sketch")
    ends = encoded.where("sketch is not null").drop("sequence_id")
    statistics = corpus_statistics(ends)
    count = statistics.documents
    tasks = max(
        1,
        -(-count // (SHARD * _SHARDS_PER_TASK)),
        min(docs.sparkSession.sparkContext.defaultParallelism, -(-count // SHARD)),
    )
    packed = (
        ends.repartitionByRange(tasks, "sketch", "key", "ids_crc32")
        .sortWithinPartitions("sketch", "key", "ids_crc32")
        .mapInArrow(
            lambda batches: _pack(batches, statistics, window), f"{_PIECE}, ids binary"
        )
    )
    columns = [
        id_value("key").alias(id_column), "start", "length", "ids_crc32", "doc_tokens",
        "sequence_id", "offset", *(["ids"] if with_ids else []),
    ]
    full = whole.withColumn("offset", F.lit(0).cast("long"))
    return full.select(*columns).unionByName(packed.select(*columns))


_ENCODED = (
    "key long, start long, length long, ids_crc32 long, doc_tokens long, ids binary, "
    "sketch long"
)


def _encode(batches, tokenizer_path: str, end_id: int, window: int, with_ids: bool):
    encoder = bpe.from_json(tokenizer_path)
    for batch in batches:
        done = 0
        for ids, ends in encoder.batches(batch.column("text")):
            count = len(ends)
            keys = batch.column("key").slice(done, count).to_numpy()
            done += count
            ids = np.insert(ids, ends, end_id).astype("<u4", copy=False)
            closes = ends + np.arange(1, count + 1)
            begins = np.concatenate([[0], closes[:-1]])
            totals = closes - begins
            pieces = -(-totals // window)
            owner = np.repeat(np.arange(count), pieces)
            start = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start *= window
            length = np.minimum(window, totals[owner] - start)
            at = begins[owner] + start
            data = memoryview(ids.tobytes())
            spans = [data[4 * a : 4 * b] for a, b in zip(at.tolist(), (at + length).tolist())]
            is_open = length < window
            kept = [
                bytes(x) if with_ids or o else None
                for x, o in zip(spans, is_open.tolist())
            ]
            columns = [
                keys[owner], start, length, [zlib.crc32(x) for x in spans], totals[owner],
                kept,
                pa.array(_sketches(ids, at, length), mask=~is_open),
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, _ENCODED_ARROW, strict=True)],
                schema=_ENCODED_ARROW,
            )


_ENCODED_ARROW = pa.schema(
    [(n, pa.int64()) for n in ("key", "start", "length", "ids_crc32", "doc_tokens")]
    + [("ids", pa.binary()), ("sketch", pa.int64())]
)
_PIECE_ARROW = pa.schema(
    [
        (n, pa.int64())
        for n in (
            "key", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
        )
    ]
    + [("ids", pa.binary())]
)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)],
        schema=schema,
    )


def _sketches(ids: np.ndarray, at: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Two minima over each piece's hashed ids: texts with common tokens sort together."""
    spans = np.column_stack([at, at + length]).ravel()
    minima = []
    for factor, salt, last in (
        (0x9E3779B1, 0x5BD1E995, 0x85EBCA6B), (0xC2B2AE35, 0x27D4EB2F, 0x165667B1),
    ):
        mixed = (ids * np.uint32(factor) ^ np.uint32(salt)) * np.uint32(last)
        # One value more, as the last span ends behind the ids.
        found = np.minimum.reduceat(np.append(mixed, np.uint32(0)), spans)[::2]
        minima.append(found.astype(np.int64))
    return (minima[0] >> 1 << 32) | minima[1]


class Statistics:
    """Document frequencies by token id, documents and their mean length."""

    def __init__(self, frequencies: np.ndarray, documents: int, mean_length: float):
        self.documents, self.mean_length = documents, mean_length
        rest = documents - frequencies
        self.idf = np.maximum(
            0.0, np.log((rest + 0.5) / (frequencies + 0.5))
        )  # a token of half the documents or more says nothing


def corpus_statistics(ends: DataFrame) -> Statistics:
    """Over all open ends; the vocabulary bounds what reaches the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(0, np.int64)
        own = some = np.zeros(0, np.uint8)  # of one document, and of up to 255
        held = 0
        for batch in batches:
            for ids in batch.column("ids").to_pylist():
                tokens = np.frombuffer(ids, "<u4")
                if (most := int(tokens.max())) >= len(own):
                    more = (0, most + 1 - len(own))
                    found, own, some = (np.pad(x, more) for x in (found, own, some))
                own[tokens] = 1
                some += own
                own[tokens] = 0
                held += 1
                if held == 255:
                    found += some
                    some[:] = 0
                    held = 0
        found += some
        tokens = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array(tokens, pa.int64()), pa.array(found[tokens], pa.int64())],
            ["token", "found"],
        )

    size = ends.agg(
        F.count("*").alias("n"), F.coalesce(F.avg("length"), F.lit(1.0)).alias("mean")
    ).collect()[0]
    rows = (
        ends.select("ids")
        .mapInArrow(count, "token long, found long")
        .groupBy("token")
        .agg(F.sum("found").alias("found"))
        .toPandas()
    )
    frequencies = np.zeros(int(rows["token"].max()) + 1 if len(rows) else 0)
    frequencies[rows["token"].to_numpy(np.int64)] = rows["found"]
    return Statistics(frequencies, size["n"], size["mean"])


class InvertedIndex:
    """BM25 postings of one shard."""

    def __init__(self, documents: list[np.ndarray], statistics: Statistics):
        parts = [np.unique(x, return_counts=True) for x in documents]
        terms = [t[statistics.idf[t] > 0] for t, _ in parts]
        sizes = [len(t) for t, _ in parts]
        owner = np.repeat(np.arange(len(documents)), sizes)
        term = np.concatenate([t for t, _ in parts]).astype(np.int64)
        often = np.concatenate([c for _, c in parts]).astype(float)
        length = np.array([len(x) for x in documents])[owner]
        norm = _K1 * (1 - _B + _B * length / statistics.mean_length)
        weight = statistics.idf[term] * often * (_K1 + 1) / (often + norm)
        used = weight > 0
        order = np.argsort(term[used], kind="stable")
        self.owner, self.weight = owner[used][order], weight[used][order]
        ordered = term[used][order]
        present, begins = np.unique(ordered, return_index=True)
        self.begins = np.append(begins, len(ordered))
        self.size = len(documents)
        ends = np.cumsum([len(t) for t in terms])
        self.places = np.split(np.searchsorted(present, np.concatenate(terms)), ends[:-1])

    def keep(self, documents: np.ndarray) -> None:
        """Drop the postings of the documents that are false in ``documents``."""
        some = documents[self.owner]
        self.owner, self.weight = self.owner[some], self.weight[some]
        self.begins = np.concatenate([[0], np.cumsum(some)])[self.begins]

    def scores(self, document: int) -> np.ndarray:
        """BM25 of every other kept document for the terms of one of them."""
        at = self.places[document]
        begins, ends = self.begins[at], self.begins[at + 1]
        shared = ends - begins > 1  # the others are in this document only
        slices = [
            slice(a, b)
            for a, b in zip(begins[shared].tolist(), ends[shared].tolist(), strict=True)
        ]
        if not slices:
            return np.zeros(self.size)
        return np.bincount(
            np.concatenate([self.owner[s] for s in slices]),
            np.concatenate([self.weight[s] for s in slices]),
            self.size,
        )


def _pack(batches, statistics: Statistics, window: int):
    sequence = TaskContext.get().partitionId() << 32
    waiting: list[dict] = []
    for batch in batches:
        waiting += batch.to_pylist()
        while len(waiting) >= SHARD:
            shard, waiting = waiting[:SHARD], waiting[SHARD:]
            rows, sequence = _pack_shard(shard, statistics, window, sequence)
            yield _batch(rows, _PIECE_ARROW)
    if waiting:
        rows, sequence = _pack_shard(waiting, statistics, window, sequence)
        yield _batch(rows, _PIECE_ARROW)


def _pack_shard(shard: list[dict], statistics: Statistics, window: int, sequence: int):
    documents = [np.frombuffer(x["ids"], "<u4") for x in shard]
    index = InvertedIndex(documents, statistics)
    taken = np.zeros(len(shard), np.int64)  # tokens already placed
    left = np.array([len(x) for x in documents])
    rows: list[tuple] = []
    indexed = len(shard)
    for seed in range(len(shard)):
        while left[seed]:
            unused = left > 0
            if (count := int(unused.sum())) <= _REINDEX * indexed:
                index.keep(unused)
                indexed = count
            room = window
            for i in _candidates(index, seed, left):
                size = int(min(room, left[i]))
                start = int(taken[i])
                own = documents[i][start : start + size].tobytes()
                rows.append(
                    (
                        shard[i]["key"], shard[i]["start"] + start, size,
                        zlib.crc32(own), shard[i]["doc_tokens"], 2 * sequence,
                        window - room, own,
                    )
                )
                taken[i] += size
                left[i] -= size
                room -= size
                if not room:
                    break
            sequence += 1
    return rows, sequence


def _candidates(index: InvertedIndex, seed: int, left: np.ndarray) -> Iterator[int]:
    """The seed, then unused documents by falling score, ties by position."""
    yield seed
    scores = np.where(left > 0, index.scores(seed), -1.0)
    scores[seed] = -1.0
    some = min(32, len(scores) - 1)
    if some > 0:
        best = np.argpartition(-scores, some)[:some]
        floor = scores[best].min()
        sure = best[(scores[best] > floor) & (scores[best] >= 0)]
        yield from sure[np.lexsort((sure, -scores[sure]))].tolist()
    else:
        floor = np.inf
    rest = np.flatnonzero((scores <= floor) & (scores >= 0))
    yield from rest[np.argsort(-scores[rest], kind="stable")].tolist()
