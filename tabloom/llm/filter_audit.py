"""Filter interaction audit: what each of five filters removes, in every order.

Duplicates are found with compressed tries. Every task inserts the texts it
reads into a trie of its own, which leaves one row for each text of the task;
these are range-partitioned by text prefixes, longer where many texts begin
alike, and one trie per range holds the smallest id at the end of each text. A document then is
a mask of the filters it fails, and all orders follow from counts of masks.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import NULL_ID, Scratch, binary, id_key
from tabloom.operators.skew import lookup_join

FILTERS = "ABCDE"
_DUPLICATE = 1 << FILTERS.index("E")
_UPPER = bytes(range(0x41, 0x5B))
_NOT_UPPER = bytes(set(range(256)) - set(_UPPER))
_SYMBOL = re.compile(rb"[#$%&*|]")
_TRIE_BYTES = 32 << 20  # texts that one trie of the first pass holds
_RANGE_BYTES = 32 << 20  # texts of one range, but for a single text's copies
_MOST_PREFIXES = 10_000  # ranges grow beyond this many
_FIRST_PREFIX = 4
_COUNTS = [
    "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley",
]
_ROWS = "text binary, doc_id long, part string, mask int, n long"


class Node:
    """A node of a compressed trie: the bytes that lead to it and what ends here."""

    __slots__ = ("edge", "children", "owner", "rows")

    def __init__(self, edge: bytes):
        self.edge = edge
        self.children: dict[int, Node] | None = None
        self.owner: int | None = None  # the smallest id of the text that ends here
        self.rows: Counter | None = None  # (part, mask) of the rows with that id


def _shared(edge: bytes, text: bytes, at: int) -> int:
    """Bytes that ``edge`` and ``text`` from ``at`` have in common, by halving."""
    low, high = 0, min(len(edge), len(text) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if edge[low:middle] == text[at + low : at + middle]:
            low = middle
        else:
            high = middle - 1
    return low


class Trie:
    def __init__(self):
        self.root = Node(b"")

    def end_of(self, text: bytes) -> Node:
        """The node at which ``text`` ends, made if there is none."""
        node, at = self.root, 0
        while at < len(text):
            if node.children is None:
                node.children = {}
            child = node.children.get(text[at])
            if child is None:
                child = node.children[text[at]] = Node(text[at:])
                return child
            if not text.startswith(child.edge, at):
                same = _shared(child.edge, text, at)
                upper = node.children[text[at]] = Node(child.edge[:same])
                upper.children = {child.edge[same]: child}
                child.edge = child.edge[same:]
                child = upper
            node, at = child, at + len(child.edge)
        return node

    def ends(self) -> Iterator[tuple[bytes, Node]]:
        """Every text with its node."""
        stack = [(b"", self.root)]
        while stack:
            before, node = stack.pop()
            text = before + node.edge
            if node.owner is not None:
                yield text, node
            stack.extend((text, child) for child in (node.children or {}).values())


class Audit:
    """Settles rows: copies at once, the smallest id of a text when asked."""

    def __init__(self):
        self.trie = Trie()
        self.settled: list[tuple] = []

    def add(self, text: bytes, doc: int, part: str, mask: int, n: int) -> bool:
        """True if the text is new to the trie."""
        node = self.trie.end_of(text)
        new = node.owner is None
        if new or doc < node.owner:
            if not new:
                self._copies(node.owner, node.rows.items())
            node.owner, node.rows = doc, Counter()
        if doc == node.owner:
            node.rows[part, mask] += n
        else:
            self._copies(doc, [((part, mask), n)])
        return new

    def _copies(self, doc: int, rows) -> None:
        for (part, mask), n in rows:
            self.settled.append((None, doc, part, mask | _DUPLICATE, n))

    def firsts(self) -> Iterator[tuple]:
        for text, node in self.trie.ends():
            for (part, mask), n in node.rows.items():
                yield text, node.owner, part, mask, n

    def take(self) -> list[tuple]:
        rows, self.settled = self.settled, []
        return rows


def failed(text: bytes) -> int:
    """The mask of the conditions A to D that a text meets."""
    words = text.split()
    points = len(text.decode())
    return (
        (len(words) < 200)
        | (100 * len(set(words)) < 50 * len(words)) << 1
        | (100 * len(text.translate(None, _NOT_UPPER)) > 3 * points) << 2
        | bool(_SYMBOL.search(text)) << 3
    )


def _batch(rows: list[tuple], size: int = 2000) -> Iterator[pa.RecordBatch]:
    kinds = [pa.binary(), pa.int64(), pa.string(), pa.int32(), pa.int64()]
    names = ["text", "doc_id", "part", "mask", "n"]
    for begin in range(0, len(rows), size):
        columns = zip(*rows[begin : begin + size], strict=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
        )


def _first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    audit, held = Audit(), 0
    for batch in batches:
        for begin in range(0, batch.num_rows, 500):
            part = batch.slice(begin, 500)
            keys, langs = (part.column(c).to_pylist() for c in ("doc_id", "part"))
            for text, key, lang in zip(
                binary(part.column("text")), keys, langs, strict=True
            ):
                if audit.add(text, key, lang, failed(text), 1):
                    held += len(text)
            yield from _batch(audit.take())
            if held > _TRIE_BYTES:
                yield from _firsts(audit)
                audit, held = Audit(), 0
    yield from _firsts(audit)


def _firsts(audit: Audit) -> Iterator[pa.RecordBatch]:
    waiting, size = [], 0
    for row in audit.firsts():
        waiting.append(row)
        size += len(row[0])
        if size > 4 << 20:
            yield from _batch(waiting)
            waiting, size = [], 0
    yield from _batch(waiting)


def _second_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    audit = Audit()
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in batch.schema.names]
        for row in zip(*columns, strict=True):
            audit.add(*row)
        yield from _batch(audit.take())
    waiting = []
    for row in audit.firsts():
        waiting.append((None, *row[1:]))
        if len(waiting) == 10_000:
            yield from _batch(waiting)
            waiting = []
    yield from _batch(waiting)


def adaptive_prefix(texts: DataFrame, range_bytes: int = _RANGE_BYTES) -> Column:
    """The prefix of ``text`` that decides its range.

    The shortest of 4, 8, 16, ... bytes which no more than ``range_bytes`` of
    texts begin with, or the whole text. The driver holds the longer prefixes
    that too many begin with: at most ``_MOST_PREFIXES`` a length, as ranges
    grow with the table beyond that.
    """
    size = F.octet_length("text")
    total = texts.agg(F.sum(size)).first()[0] or 0
    limit = max(range_bytes, total // _MOST_PREFIXES)
    heavy: list[tuple[int, list[bytearray]]] = []
    length, left = _FIRST_PREFIX, texts.where(size > _FIRST_PREFIX)
    while True:
        head = F.substring("text", 1, length)
        found = (
            left.groupBy(head.alias("head"))
            .agg(F.sum(size).alias("bytes"))
            .where(F.col("bytes") > limit)
            .select("head")
            .collect()
        )
        if not found:
            break
        heavy.append((length, [bytearray(r["head"]) for r in found]))
        left = left.where(head.isin(heavy[-1][1]) & (size > 2 * length))
        length *= 2
    key = F.substring("text", 1, length)
    for shorter, heads in reversed(heavy):
        head = F.substring("text", 1, shorter)
        key = F.when(head.isin(heads), key).otherwise(head)
    return key


def masks(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    part_column: str = "lang",
    range_bytes: int = _RANGE_BYTES,
) -> DataFrame:
    """Which filters every document fails: ``doc_id`` (see ``id_key``), ``part``,
    ``mask`` (bits of A to E) and ``n`` (rows of that id, part and mask).

    A null text is an empty one, a null part the empty string. Null ids are one
    id, larger than all others; of rows that repeat the smallest id of a text
    none is a duplicate, as no id is smaller.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    rows = docs.select(
        F.col(text_column).alias("text"),
        id_key(id_column).alias("doc_id"),
        F.coalesce(F.col(part_column).cast("string"), F.lit("")).alias("part"),
    )
    first = scratch.store(rows.mapInArrow(_first_pass, _ROWS), "audit-first")
    texts = first.where("text is not null")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(spark.sparkContext.defaultParallelism, -(-size // range_bytes))
    ranged = texts.repartitionByRange(ranges, adaptive_prefix(texts, range_bytes))
    second = scratch.store(ranged.mapInArrow(_second_pass, _ROWS), "audit-second")
    settled = first.where("text is null").unionByName(second)
    return settled.select("doc_id", "part", "mask", "n")


def _orders() -> list[tuple[str, int, np.ndarray, int]]:
    """Filter order, step, the filters applied before (mask) and the step's own."""
    found = []
    for order in permutations(FILTERS):
        before = 0
        for step, name in enumerate(order, 1):
            own = 1 << FILTERS.index(name)
            found.append(("".join(order), step, before, own))
            before |= own
    return found


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All orders of one part from its counts by mask."""
    steps = _orders()
    order = [x[0] for x in steps]
    step = [x[1] for x in steps]
    mask = np.arange(1 << len(FILTERS))
    before = np.array([x[2] for x in steps])[:, None]
    own = np.array([x[3] for x in steps])[:, None]
    fails, earlier = (mask & own) > 0, (mask & before) > 0
    removed = fails & ~earlier
    matrices = {
        "kept": ~(fails | earlier),
        "removed": removed,
        "redundant": fails & earlier,
        "unique_fails": np.broadcast_to(mask == own, fails.shape),
    }
    # A document falls to each filter that it fails in an equal share of the orders.
    orders = len(steps) // len(FILTERS)
    shares = np.array([orders // max(1, int(m).bit_count()) for m in mask])
    for batch in batches:
        for part, cells in zip(
            *(batch.column(c).to_pylist() for c in ("part", "cells")), strict=True
        ):
            counts = np.zeros((3, len(mask)), np.int64)
            for cell in cells:
                counts[:, cell["mask"]] = cell["n"], cell["good"], cell["toxic"]
            columns = {k: m.astype(np.int64) @ counts[0] for k, m in matrices.items()}
            columns["good_lost"] = removed.astype(np.int64) @ counts[1]
            columns["toxic_lost"] = removed.astype(np.int64) @ counts[2]
            columns["shapley"] = fails.astype(np.int64) @ (shares * counts[0])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part] * len(steps)),
                    pa.array(order),
                    pa.array(step, pa.int32()),
                    *(pa.array(columns[c]) for c in _COUNTS),
                ],
                ["part", "filter_order", "step", *_COUNTS],
            )


def audit(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    part_column: str = "lang",
    range_bytes: int = _RANGE_BYTES,
) -> DataFrame:
    """What the filters A to E remove in all 120 orders, per value of a column.

    Returns ``part``, ``filter_order``, ``step`` and, for the filter of that
    step, ``kept``, ``removed``, ``redundant``, ``unique_fails``, ``good_lost``
    and ``toxic_lost`` (removed here, with ``quality`` or ``toxic`` 1 in any row
    of ``labels``) and ``shapley`` (removed, summed over all orders). Nulls and
    repeated ids: see ``masks``; a row without an id has no label. An empty
    table has no part and gives no rows; other columns are left out.
    """
    marked = masks(docs, id_column, text_column, part_column, range_bytes)
    good, toxic = (
        F.max(F.coalesce((F.col(c) == 1).cast("long"), F.lit(0)))
        for c in ("quality", "toxic")
    )
    flags = (
        labels.where("quality = 1 or toxic = 1")
        .groupBy(F.col(id_column).cast("long").alias("doc_id"))
        .agg(good.alias("good"), toxic.alias("toxic"))
        .where(F.col("doc_id") < NULL_ID)
    )
    cells = (
        lookup_join(marked, flags, ["doc_id"])
        .groupBy("part", "mask")
        .agg(
            F.sum("n").alias("n"),
            F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("good"),
            F.sum(F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic"),
        )
    )
    per_part = cells.groupBy("part").agg(  # at most 32 cells
        F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells")
    )
    counts = ", ".join(f"{c} long" for c in _COUNTS)
    return per_part.mapInArrow(
        _report, f"part string, filter_order string, step int, {counts}"
    )
