"""Vector codes: product codebooks trained by ball k-means in whole numbers.

A part of a vector lies in the ball of its codebook entry. Entries farther away
than twice the ball's radius are no neighbours of it: no member can be nearer to
them. Members nearer to their entry than half the way to its nearest neighbour
are the stable core and keep it without a comparison; those in the ring between
the half ways to two consecutive neighbours compare the inner ones only. Every
comparison is of whole numbers, so what is skipped cannot change a result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import Scratch, id_key, id_value
from tabloom.operators.skew import lookup_join

_LARGEST = 1 << 24  # of a scaled component: sums of squares stay below 2 ** 63
_ROWS = "key long, label string, vector binary, code binary, parts array<struct<part: int, entry: int, count: long, sums: array<long>>>"


@dataclass
class Codebooks:
    """Per part the entries, one row each, as whole numbers."""

    entries: list[np.ndarray]
    bounds: list[int]  # where the parts begin, and the length

    def digest(self) -> str:
        numbers = ",".join(
            str(x) for part in self.entries for x in part.ravel().tolist()
        )
        return hashlib.sha256(numbers.encode()).hexdigest()


def squares(x: np.ndarray, entry: np.ndarray) -> np.ndarray:
    """Squared distances of rows."""
    apart = x - entry
    return np.einsum("ij,ij->i", apart, apart)


def nearest(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """The nearest entry of every row, the first of equally near ones."""
    best = np.zeros(len(x), np.uint8)
    least = squares(x, entries[0])
    for j in range(1, len(entries)):
        found = squares(x, entries[j])
        nearer = found < least
        best[nearer], least[nearer] = j, found[nearer]
    return best


def moved(x: np.ndarray, entries: np.ndarray, code: np.ndarray) -> np.ndarray:
    """The nearest entry of every row, from the entry it had before."""
    code = code.copy()
    gaps = np.array([squares(entries, e) for e in entries])
    own = squares(x, entries[code])
    before = code.copy()
    for i in range(len(entries)):
        members = np.flatnonzero(before == i)
        if not len(members):
            continue
        radius = own[members].max()
        near = [j for j in np.argsort(gaps[i], kind="stable") if j != i]
        # Half the way to entry j, squared, is gaps / 4; equally near counts.
        near = [j for j in near if gaps[i, j] <= 4 * radius]
        least = own[members].copy()
        for j in near:  # ring by ring: what lies within half the way to j is done
            outer = np.flatnonzero(gaps[i, j] <= 4 * own[members])
            if not len(outer):
                break
            rows = members[outer]
            found = squares(x[rows], entries[j])
            better = (found < least[outer]) | (
                (found == least[outer]) & (j < code[rows])
            )
            code[rows[better]] = j
            least[outer[better]] = found[better]
    return code


def _whole(vectors: DataFrame, id_column, vector_column, label_column, scale):
    """Usable rows with their scaled components."""
    v = F.col(vector_column).cast("array<double>")
    usable = F.forall(
        v, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False))
    ) & (F.size(v) > 0)
    limit = F.lit(float(_LARGEST))
    return vectors.where(F.coalesce(usable, F.lit(False))).select(
        id_key(id_column).alias("key"),
        F.col(label_column).cast("string").alias("label"),
        F.transform(
            v, lambda x: F.floor(F.greatest(-limit, F.least(limit, x * scale)))
        ).alias("vector"),
    )


def _unpack(column: pa.Array, length: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i4").reshape(-1, length)


def _pack(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Vectors as little-endian 32-bit numbers."""
    for batch in batches:
        values = batch.column("vector").flatten().to_numpy().astype("<i4")
        rows = [r.tobytes() for r in values.reshape(-1, length)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), batch.column("label"), pa.array(rows, pa.binary())],
            ["key", "label", "vector"],
        )


def _step(batches: Iterator[pa.RecordBatch], books: Codebooks, first: bool):
    """Assign all rows; at the end the task's sums by part and entry."""
    parts = list(zip(books.bounds[:-1], books.bounds[1:], strict=True))
    counts = [np.zeros(len(e), np.int64) for e in books.entries]
    sums = [np.zeros(e.shape, np.int64) for e in books.entries]
    kind = pa.list_(
        pa.struct(
            [
                ("part", pa.int32()),
                ("entry", pa.int32()),
                ("count", pa.int64()),
                ("sums", pa.list_(pa.int64())),
            ]
        )
    )
    names = ["key", "label", "vector", "code", "parts"]
    for batch in batches:
        if not batch.num_rows:
            continue
        x = _unpack(batch.column("vector"), books.bounds[-1]).astype(np.int64)
        if first:
            code = np.zeros((len(x), len(parts)), np.uint8)
        else:
            old = b"".join(batch.column("code").to_pylist())
            code = np.frombuffer(old, np.uint8).reshape(len(x), -1).copy()
        for p, (begin, end) in enumerate(parts):
            entries, part = books.entries[p], np.ascontiguousarray(x[:, begin:end])
            code[:, p] = (
                nearest(part, entries) if first else moved(part, entries, code[:, p])
            )
            counts[p] += np.bincount(code[:, p], minlength=len(entries))
            for e in range(len(entries)):
                sums[p][e] += part[code[:, p] == e].sum(axis=0)
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(c) for c in names[:3]),
                pa.array([r.tobytes() for r in code], pa.binary()),
                pa.nulls(len(x), kind),
            ],
            names,
        )
    found = [
        {"part": p, "entry": e, "count": int(n), "sums": sums[p][e].tolist()}
        for p, of in enumerate(counts)
        for e, n in enumerate(of)
        if n
    ]
    if found:
        yield pa.RecordBatch.from_arrays(
            [
                pa.nulls(1, pa.int64()),
                pa.nulls(1, pa.string()),
                pa.nulls(1, pa.binary()),
                pa.nulls(1, pa.binary()),
                pa.array([found], kind),
            ],
            names,
        )


def _updated(books: Codebooks, assigned: DataFrame) -> Codebooks:
    """Entries replaced by the floor of their members' means."""
    cell = assigned.where("parts is not null").select(F.inline("parts"))
    totals = (
        cell.select("part", "entry", "count", F.posexplode("sums").alias("at", "sum"))
        .groupBy("part", "entry", "at")
        .agg(F.sum("count").alias("count"), F.sum("sum").alias("sum"))
        .collect()  # one row per number of the codebooks
    )
    entries = [e.copy() for e in books.entries]
    for r in totals:
        entries[r["part"]][r["entry"], r["at"]] = r["sum"] // r["count"]
    return Codebooks(entries, books.bounds)


def _errors(batches: Iterator[pa.RecordBatch], books: Codebooks):
    for batch in batches:
        if not batch.num_rows:
            continue
        x = _unpack(batch.column("vector"), books.bounds[-1]).astype(np.int64)
        code = np.frombuffer(
            b"".join(batch.column("code").to_pylist()), np.uint8
        ).reshape(len(x), -1)
        error = np.zeros(len(x), np.int64)
        for p, entries in enumerate(books.entries):
            part = x[:, books.bounds[p] : books.bounds[p + 1]]
            error += squares(part, entries[code[:, p]])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("key"),
                batch.column("label"),
                pa.array([r.tobytes().hex() for r in code]),
                pa.array(error),
            ],
            ["key", "label", "code", "error"],
        )


def compress(
    vectors: DataFrame,
    parts: int = 8,
    entries: int = 16,
    rounds: int = 6,
    scale: int = 4096,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
) -> tuple[DataFrame, Codebooks]:
    """Train codebooks on all vectors and encode them.

    Components become whole numbers, ``floor(scale * x)``, held to 2 ** 24 in
    size. Every part's codebook starts as that part of the first vectors by id
    (equal ids by vector, null ids last; fewer vectors, fewer entries). A round
    assigns every part to its nearest entry, ties to the lower index, and
    replaces each entry by the floor of its members' mean; unused ones stay.

    Returns the codebooks and ``id_column``, ``code`` (two hex digits a part),
    ``error`` (squared distance to the entries) and ``label_error`` (summed over
    equal labels, nulls together). Vectors that are null, empty or hold null or
    non-finite components are left out, and so are those whose length is not
    the table's most frequent one (the longer of two). A length that the parts
    do not divide is cut at ``length * i // parts``. Rows that repeat an id are
    encoded each; an empty table gives no rows and codebooks without entries;
    other columns are left out.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark)
    whole = _whole(vectors, id_column, vector_column, label_column, scale)
    size = F.size("vector")
    common = whole.groupBy(size.alias("n")).count().orderBy(F.desc("count"), F.desc("n"))
    length = (common.first() or {"n": parts})["n"]
    bounds = [length * i // parts for i in range(parts + 1)]
    state = scratch.store(
        whole.where(size == length).mapInArrow(
            lambda batches: _pack(batches, length),
            "key long, label string, vector binary",
        ),
        "vectors",
    )
    start = whole.where(size == length).orderBy("key", "vector").limit(entries).collect()
    seeds = np.array([r["vector"] for r in start], np.int64).reshape(len(start), length)
    books = Codebooks(
        [seeds[:, a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)], bounds
    )
    if not start:
        empty = f"{id_column} long, code string, error long, label_error long"
        return spark.createDataFrame([], empty), books
    before = "vectors"
    for turn in range(rounds + 1):
        step = state.where("vector is not null").mapInArrow(
            lambda batches, b=books, t=turn: _step(batches, b, t == 0), _ROWS
        )
        state = scratch.store(step, f"round-{turn}")
        scratch.drop(before)
        before = f"round-{turn}"
        if turn < rounds:
            books = _updated(books, state)
    final = books
    coded = state.where("vector is not null").mapInArrow(
        lambda batches: _errors(batches, final),
        "key long, label string, code string, error long",
    )
    # A label of its own for null, which no other label's text can be.
    named = coded.withColumn(
        "label", F.coalesce(F.concat(F.lit("="), "label"), F.lit(""))
    )
    sums = named.groupBy("label").agg(F.sum("error").alias("label_error"))
    found = lookup_join(named, sums, ["label"])
    return (
        found.select(id_value("key").alias(id_column), "code", "error", "label_error"),
        final,
    )
