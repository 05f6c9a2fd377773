"""SimHash near-duplicates through pivot distance tables."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import (
    binary,
    forest_edges,
    id_key,
    id_value,
    in_chunk_pairs,
    materialize,
    sorted_groups,
)
from tabloom.llm.components import connected_components
from tabloom.operators.skew import lookup_join

CHUNK = 4096
_SEED = 42
# Reference fingerprints, the same on every task.
PIVOTS = np.random.default_rng(64).integers(0, 1 << 64, 24, np.uint64, endpoint=False)


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """A bit is 1 if it is set in over half of the hashes of the shingles."""
    words = text.lower().split()  # bytes: A-Z only, ASCII white space only
    if not words:
        return 0
    size = min(shingle, len(words))
    runs = map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False))
    hashes = np.fromiter(
        (xxhash.xxh64_intdigest(run, _SEED) for run in runs), np.uint64
    )
    ones = np.zeros(64, np.int64)
    for begin in range(0, len(hashes), 65_536):
        part = hashes[begin : begin + 65_536].astype("<u8").view(np.uint8)
        bits = np.unpackbits(part.reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(
    docs: DataFrame,
    shingle: int = 3,
    id_column: str = "doc_id",
    text_column: str = "text",
    row: str | None = None,
) -> DataFrame:
    """``key`` (see ``id_key``) and ``fp``, the fingerprint as a signed long.

    ``row`` names a long column to carry along as ``row``.
    """
    names = ["key", *(["row"] if row else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t, shingle) for t in binary(batch.column("text"))]
            fp = np.array(found, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names], pa.array(fp)], [*names, "fp"]
            )

    rows = docs.select(
        id_key(id_column).alias("key"),
        *([F.col(row).alias("row")] if row else []),
        F.col(text_column).alias("text"),
    )
    return rows.mapInArrow(run, ", ".join(f"{n} long" for n in [*names, "fp"]))


def block_keys(distance: int) -> F.Column:
    """Keys of which two fingerprints within ``distance`` bits share at least one.

    The bits are cut into ``distance`` + 2 blocks; that many differing bits
    leave two blocks or more untouched, so every pair of blocks is a key.
    """
    count = distance + 2
    edges = [64 * i // count for i in range(count + 1)]
    blocks = [
        F.shiftrightunsigned("fp", low).bitwiseAND(F.lit((1 << (high - low)) - 1))
        for low, high in zip(edges[:-1], edges[1:], strict=True)
    ]
    wide = max(b - a for a, b in zip(edges[:-1], edges[1:], strict=True))
    return F.array(
        *[
            F.lit(n << (2 * wide))
            .bitwiseOR(F.shiftleft(blocks[i], wide))
            .bitwiseOR(blocks[j])
            for n, (i, j) in enumerate(combinations(range(count), 2))
        ]
    )


def near_pairs(
    fps: np.ndarray, distance: int, apart: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all pairs within ``distance`` bits, through a pivot table.

    The table has the distance of each fingerprint to each pivot. Rows are
    sorted by the first pivot, so only a band can hold partners; a pair is
    discarded as soon as one coordinate differs by more than ``distance``;
    survivors are verified. With ``apart`` only pairs that differ in it count.
    """
    table = np.bitwise_count(fps[:, None] ^ PIVOTS).astype(np.int8)
    order = np.argsort(table[:, 0], kind="stable")
    table, fps = table[order], fps[order]
    apart = None if apart is None else apart[order]
    found = []
    for begin in range(0, len(fps), 256):
        end = min(begin + 256, len(fps))
        last = np.searchsorted(table[:, 0], table[end - 1, 0] + distance, "right")
        i, j = np.nonzero(
            table[begin:last, 0][None, :] - table[begin:end, 0][:, None] <= distance
        )
        i, j = i + begin, j + begin
        keep = i < j
        if apart is not None:
            keep &= apart[i] != apart[j]
        i, j = i[keep], j[keep]
        for pivot in range(1, len(PIVOTS)):
            if len(i) < 4 * len(PIVOTS):
                break  # verification is cheaper now
            close = np.abs(table[i, pivot] - table[j, pivot]) <= distance
            i, j = i[close], j[close]
        close = np.bitwise_count(fps[i] ^ fps[j]) <= distance
        found.append((order[i[close]], order[j[close]]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _links(batches: Iterator[pa.RecordBatch], distance: int):
    for group in sorted_groups(batches, ["block", "lo", "hi"], least=2):
        fps = group.column("fp").to_numpy().view(np.uint64)
        two = group.column("lo")[0].as_py() != group.column("hi")[0].as_py()
        apart = group.column("part").to_numpy() if two else None
        yield forest_edges(len(fps), *near_pairs(fps, distance, apart), fps.view(np.int64))


def near_duplicates(
    docs: DataFrame,
    shingle: int = 3,
    distance: int = 3,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Groups of documents whose fingerprints differ in ``distance`` bits or fewer.

    Fingerprints are of whole texts: words between ASCII white space, A-Z in
    lower case, shingles of ``shingle`` words with repeats. Returns a row per
    document: ``id_column``, ``fingerprint`` (16 hex digits) and
    ``component_id`` (smallest id reachable by links, itself included).

    Equal fingerprints are one class. Classes meet through ``block_keys``; a
    key that many share is cut into chunk pairs, and a task passes on a
    forest of the links that it verified, never the pairs.

    A null or empty text has fingerprint zero and links like any other; null
    ids are one id, larger than all others; rows that repeat stay; an empty
    table gives an empty table; other columns are left out.
    """
    found = materialize(
        fingerprints(docs, shingle, id_column, text_column), "fingerprints"
    )
    named = _class_components(found, distance).select(
        "fp", F.col("stays.key").alias("component")
    )
    return found.join(named, "fp").select(
        id_value("key").alias(id_column),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        id_value("component").alias("component_id"),
    )


def _class_components(found: DataFrame, distance: int) -> DataFrame:
    """For each ``fp`` the smallest (``key``, ``row``) of its component, ``stays``.

    ``found`` is stored; ``row`` may be left out. Classes are linked by their
    fingerprints: an id may be in several.
    """
    place = [c for c in ("key", "row") if c in found.columns]
    classes = materialize(
        found.groupBy("fp").agg(F.min(F.struct(*place)).alias("rep")),
        "fingerprint-classes",
    )
    keyed = classes.select(F.explode(block_keys(distance)).alias("block"), "fp")
    edges = in_chunk_pairs(keyed, "block", "fp", CHUNK).mapInArrow(
        lambda batches: _links(batches, distance), "a long, b long"
    )
    joined = classes.join(
        connected_components(edges).withColumnRenamed("node", "fp"), "fp", "left"
    ).withColumn("component", F.coalesce("component", "fp"))
    heads = joined.groupBy("component").agg(F.min("rep").alias("stays"))
    found = lookup_join(joined, heads, ["component"], "inner")
    return found.select("fp", "stays")


def deduplicated(
    docs: DataFrame,
    shingle: int = 3,
    distance: int = 3,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row of each group of near-duplicates: that of the smallest id.

    Of rows that share that id, one stays, so that repeated and null ids lose
    no other text and keep no copy. ``docs`` is stored first: rows have no
    other identity.
    """
    rows = materialize(
        docs.select(
            F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "simhash-rows",
    )
    found = materialize(
        fingerprints(
            rows,
            shingle,
            f"document.`{id_column}`",
            f"document.`{text_column}`",
            row="row",
        ),
        "fingerprints",
    )
    stays = _class_components(found, distance).select("stays.row").distinct()
    return rows.join(stays, "row", "left_semi").select("document.*")
