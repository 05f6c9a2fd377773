"""Byte-level BPE: encode whole texts with offsets, decode ids to bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm import bpe
from tabloom.llm.common import id_key, id_value


def encode(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    offsets: bool = False,
) -> DataFrame:
    """Ids of every whole text by the ranks in ``ranks_path``, no special tokens.

    Returns ``id_column``, ``ids`` (binary: little-endian unsigned 32-bit) and,
    with ``offsets``, ``begins`` and ``ends`` (arrays of ints): the characters
    of the text that each token touches. A character split over several tokens
    belongs to each of them.

    A null or empty text has no ids; a null id stays null; repeated rows are
    encoded each; an empty table gives an empty table; other columns are left
    out. ``ranks_path`` must exist on every executor.
    """
    schema = "key long, ids binary" + (
        ", begins array<int>, ends array<int>" if offsets else ""
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe.from_ranks(ranks_path, pattern)
        widths = _token_widths(ranks_path) if offsets else None
        for batch in batches:
            for part in _slices(batch):
                texts = [x or "" for x in part.column("text").to_pylist()]
                ids = encoder.encode(texts)
                columns = [part.column("key"), pa.array(ids, pa.binary())]
                if offsets:
                    spans = [
                        char_spans(t, np.frombuffer(i, "<u4"), widths)
                        for t, i in zip(texts, ids, strict=True)
                    ]
                    columns += [
                        pa.array([s[k] for s in spans], pa.list_(pa.int32()))
                        for k in (0, 1)
                    ]
                names = ["key", "ids", "begins", "ends"][: len(columns)]
                yield pa.RecordBatch.from_arrays(columns, names)

    rows = docs.select(id_key(id_column).alias("key"), F.col(text_column).alias("text"))
    out = rows.mapInArrow(run, schema)
    return out.select(id_value("key").alias(id_column), *out.columns[1:])


def decode(
    encoded: DataFrame, ranks_path: str, ids_column: str = "ids", to: str = "decoded"
) -> DataFrame:
    """Adds ``to`` (binary): the bytes that the ids stand for.

    Bytes, not text: a list of ids may begin or end inside a character. Null
    ids decode to null; an id that has no token fails. All columns stay; one
    that is named like ``to`` is replaced.
    """
    table: list[bytes] = []

    @F.pandas_udf("binary")
    def join_tokens(column):
        if not table:
            table.extend(_tokens(ranks_path))
        return column.map(
            lambda ids: (
                None
                if ids is None
                else b"".join(
                    map(table.__getitem__, np.frombuffer(ids, "<u4").tolist())
                )
            )
        )

    return encoded.withColumn(to, join_tokens(F.col(ids_column)))


def _slices(batch: pa.RecordBatch, rows: int = 500) -> Iterator[pa.RecordBatch]:
    for begin in range(0, batch.num_rows, rows):
        yield batch.slice(begin, rows)


def _tokens(path: str) -> list[bytes]:
    """The byte table reversed: bytes of every id, read through its characters."""
    back = {c: b for b, c in enumerate(bpe.byte_characters())}
    named = bpe.from_ranks_vocabulary(path)
    out = [b""] * (max(named.values()) + 1)
    for shown, i in named.items():
        out[i] = bytes(back[c] for c in shown)
    return out


def _token_widths(path: str) -> np.ndarray:
    return np.array([len(x) for x in _tokens(path)], np.int64)


def char_spans(
    text: str, ids: np.ndarray, widths: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """First character and one past the last character that each token touches."""
    data = np.frombuffer(text.encode(), np.uint8)
    ends = np.cumsum(widths[ids]) if len(ids) else np.empty(0, np.int64)
    character = np.cumsum((data & 0xC0) != 0x80) - 1  # of each byte
    if not len(ids):
        return ends.astype(np.int32), ends.astype(np.int32)
    begins = ends - widths[ids]
    return character[begins].astype(np.int32), (character[ends - 1] + 1).astype(
        np.int32
    )
