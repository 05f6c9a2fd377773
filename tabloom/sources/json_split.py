"""JSON documents of any size, read by many tasks.

A document that is one array or one object of objects has no line to split at.
It is read as text cut at every comma, which Spark splits by byte ranges as it
does lines. Whether a comma ends an element depends on all text before it, but
only through a small state: inside a string or not, how deep, below which key.
A first pass reduces every range to what it does to either state of the quotes;
these compose along the file, one row a range, to the state each range begins
in. A second pass cuts the elements, and those that reach over a border are put
together from their two or more ends.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence
from itertools import groupby

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabloom.session import on_workers

_CLOSE = re.compile(r'(?:[^"\\]|\\.)*"', re.S)
_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*"|[{}\[\]]|"', re.S)
_KEY = re.compile(r'("(?:[^"\\]|\\.)*")\s*:\s*$', re.S)
_SPACE = re.compile(r"\s*")
_DECODER = json.JSONDecoder()
_RANGE = (
    "file string, block long, first string, inside0 boolean, depth0 int, keys0 string,"
    " inside1 boolean, depth1 int, keys1 string"
)
_STATE = "file string, block long, inside boolean, depth int, name string, level int"
_PIECE = (
    "file string, block long, part int, text string, depth int, name string,"
    " fresh boolean, whole boolean"
)


class State:
    """Where the text stands: inside a string or not, the depth, the last keys.

    The depth counts from where the reader began; ``keys`` has the last key
    whose object or array was opened at each depth.
    """

    def __init__(self, inside: bool, depth: int = 0, keys: dict | None = None):
        self.inside, self.depth, self.keys = inside, depth, dict(keys or {})

    def read(self, text: str) -> None:
        at = 0
        if self.inside:
            end = _CLOSE.match(text)
            if not end:
                return
            self.inside, at = False, end.end()
        for token in _TOKEN.finditer(text, at):
            kind = token[0]
            if kind in "{[":
                key = _KEY.search(text, at, token.start()) if kind == "{" else None
                if key:
                    self.keys[self.depth] = json.loads(key[1])
                self.depth += 1
            elif kind in "}]":
                self.depth -= 1
            elif kind == '"':  # a string that goes on behind the comma
                self.inside = True
                return


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """Rows of each byte range, which a task reads one after the other."""

    def rows():
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

    return groupby(rows(), key=lambda r: r[:2])


def _reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What every range does to a reader that begins outside or inside a string."""
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
    schema = pa.schema([(n, kinds[k]) for n, k in map(str.split, _RANGE.split(","))])
    for (file, block), rows in _runs(batches):
        states, first = (State(False), State(True)), ""
        for *_, text in rows:
            if not first:
                first = text.lstrip()[:1]
            for state in states:
                state.read(text)
        cells = [
            x for s in states for x in (s.inside, s.depth, json.dumps(sorted(s.keys.items())))
        ]
        row = dict(zip(schema.names, [file, block, first, *cells], strict=True))
        yield pa.RecordBatch.from_pylist([row], schema)


def _compose(ranges: pd.DataFrame) -> pd.DataFrame:
    """The state in which each range of a file begins."""
    out, state, opener = [], State(False), ""
    for r in ranges.sort_values("block").itertuples():
        if not opener:
            opener = r.first
        # Elements stand inside the outermost array; cells inside two objects.
        level = 1 if opener == "[" else 0
        out.append(
            (r.file, r.block, state.inside, state.depth, state.keys.get(1), level)
        )
        inside, depth, keys = (
            (r.inside1, r.depth1, r.keys1) if state.inside else (r.inside0, r.depth0, r.keys0)
        )
        moved = {at + state.depth: name for at, name in json.loads(keys)}
        state = State(bool(inside), state.depth + depth, state.keys | moved)
    return pd.DataFrame(out, columns=[c.split()[0] for c in _STATE.split(",")])


def _cut(batches: Iterator[pa.RecordBatch], columns: bool) -> Iterator[pa.RecordBatch]:
    """Elements of each range: whole ones, and the ends of those that reach out."""
    names = [c.split()[0] for c in _PIECE.split(",")]
    out: list[tuple] = []
    for (file, block), rows in _runs(batches):
        waiting: list[str] = []
        part, state = 0, None
        for _, _, text, inside, depth, name, level in rows:
            if state is None:
                state = State(inside, depth, {1: name})
                limit = 2 if columns else level
                fresh = block == 0 or (not inside and depth <= limit)
                begun = depth, name
            elif not state.inside and state.depth <= limit:
                # The comma before this chunk ends an element.
                out.append((file, block, part, ",".join(waiting), *begun, fresh, fresh))
                waiting, part, fresh = [], 1, True
                begun = state.depth, state.keys.get(1)
            waiting.append(text)
            state.read(text)
            if len(out) >= 5000:
                yield _piece_batch(out, names)
                out = []
        # Whether the element ends here is known to the next range only.
        out.append((file, block, part + 1, ",".join(waiting), *begun, fresh, False))
    yield _piece_batch(out, names)


def _piece_batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [
        pa.string(), pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.string(),
        pa.bool_(), pa.bool_(),
    ]
    columns = list(zip(*rows, strict=True)) or [[]] * len(names)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
    )


def pieces(spark: SparkSession, paths: str | Sequence[str], columns: bool) -> DataFrame:
    """The elements of every document: ``file``, ``text``, ``depth``, ``name``.

    Elements of the outermost array, or with ``columns`` the cells of the
    objects inside the outermost object; ``name`` is the key of the object that
    the cell's text begins in, ``depth`` how deep that is. A document is a file.
    """
    on_workers(spark)
    chunks = (
        spark.read.option("lineSep", ",")
        .text(paths)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.col("value").alias("text"),
        )
    )
    # One row a byte range: as many as there are scan tasks and files.
    states = (
        chunks.mapInArrow(_reduce, _RANGE).groupBy("file").applyInPandas(_compose, _STATE)
    )
    cut = chunks.join(F.broadcast(states), ["file", "block"]).mapInArrow(
        lambda batches: _cut(batches, columns), _PIECE
    )
    kept = ["file", "text", "depth", "name"]
    order = Window.partitionBy("file").orderBy("block", "part")
    reached = (
        cut.where("not whole")  # at most two ends a byte range
        .withColumn("element", F.sum(F.col("fresh").cast("int")).over(order))
        .groupBy("file", "element")
        .agg(F.sort_array(F.collect_list(F.struct("block", "part", "text", "depth", "name")))
             .alias("ends"))
        .select(
            "file",
            F.array_join(F.col("ends.text"), ",").alias("text"),
            F.col("ends")[0]["depth"].alias("depth"),
            F.col("ends")[0]["name"].alias("name"),
        )
    )
    return cut.where("whole").select(*kept).unionByName(reached)


def cell(text: str, depth: int, name: str | None) -> tuple[str, str, str | None] | None:
    """Column, row and value (as text) of one cell; None for a column without cells."""

    def skip(at: int) -> int:
        return _SPACE.match(text, at).end()

    def key(at: int) -> tuple[str, int]:
        found, at = _DECODER.raw_decode(text, at)
        return found, skip(skip(at) + 1)  # the colon

    at = skip(0)
    if depth == 0:
        at, depth = skip(at + 1), 1
    if depth == 1:
        if text[at : at + 1] != '"':
            return None
        name, at = key(at)
        at = skip(at + 1)
    if text[at : at + 1] != '"':
        return None
    row, at = key(at)
    value, end = _DECODER.raw_decode(text, at)
    if value is None or isinstance(value, str):
        return name, row, value
    return name, row, text[at:end]


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [
            (r["file"], *c)
            for r in batch.to_pylist()
            if (c := cell(r["text"], r["depth"], r["name"]))
        ]
        columns = list(zip(*found, strict=True)) or [[]] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.string()) for c in columns], ["doc", "column", "row", "value"]
        )


def read_records(
    spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """The objects of documents that are arrays, or the one object a document is."""
    element = F.regexp_replace("text", r"^\s*\[\s*|\s*\]\s*$", "")
    parsed = F.from_json("element", ", ".join(f"`{c}` string" for c in columns))
    return (
        pieces(spark, paths, False)
        .select(element.alias("element"))
        .where("trim(element) <> ''")
        .select(parsed.alias("row"))
        .select("row.*")
    )


def read_columns(
    spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Rows of documents that are objects of columns, each an object of cells."""
    cells = pieces(spark, paths, True).mapInArrow(
        _cells, "doc string, column string, row string, value string"
    )
    return (
        cells.where(F.col("column").isin(list(columns)))
        .groupBy("doc", "row")
        .agg(
            *[F.max(F.when(F.col("column") == c, F.col("value"))).alias(c) for c in columns]
        )
        .select(*columns)
    )
