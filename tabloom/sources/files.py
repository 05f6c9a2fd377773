"""Staged CSV and JSON files: listing, reading, writing results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.functions.values import MISSING, PANDAS_NULLS, null_if_in
from tabloom.operators.skew import lookup_join
from tabloom.sources import json_split

_BROADCAST_FILES = 100_000  # a row of some hundred bytes each


def list_inputs(spark: SparkSession, folder: str) -> DataFrame:
    """Files below a folder: file_name (relative to it) and path.

    The contents are not read. The part files of ``train-1.csv/`` count one by
    one, each with the folder's name in front.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    root = files.makeQualified(path).toString().rstrip("/")
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(folder)
        .select(F.substr("path", F.lit(len(root) + 2)).alias("file_name"), "path")
    )


def paths_by(listing: DataFrame, column: str) -> dict[str | None, list[str]]:
    """Paths by another column, for the readers: Spark's take a list of paths."""
    found: dict[str | None, list[str]] = {}
    for row in listing.select(column, "path").toLocalIterator():
        found.setdefault(row[column], []).append(row["path"])
    return found


def read_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Sequence[str],
    null_tokens: Sequence[str] = (*PANDAS_NULLS, MISSING),
    place: str | None = None,
) -> DataFrame:
    """CSV parts with a header, every column as text, no schema inference.

    Columns are taken by their names in each file's own header, so that parts
    may differ in the order of their columns and in further ones; a part
    without one of ``columns`` fails. The unnamed first column is a row index
    and is dropped. Text in ``null_tokens`` becomes null, and so does empty
    text in any case. ``place`` adds a column of that name which orders rows by
    file path and, within a file, as they stand there.
    """
    lines = _lines(spark, paths)
    headers = _headers(lines)
    known = headers.agg(
        F.count("*").alias("files"),
        F.max(F.size(F.split("header", ","))).alias("width"),
        F.min("header").alias("least"),
        F.max("header").alias("most"),
    ).first()
    if known["files"] == 0:
        raise ValueError(f"no columns {list(columns)} in {paths}")
    if known["least"] == known["most"]:
        raw = spark.read.option("header", True).option("escape", '"').csv(paths)
        absent = [c for c in columns if c not in raw.columns]
        if absent:
            raise ValueError(f"no columns {absent} among {raw.columns} in {paths}")
        # A task reads a block from its start, so its own row numbers ascend.
        at = _place() if place else []
    else:
        raw = _by_own_header(lines, headers, columns, known["width"], known["files"])
        at = [F.struct("file", "block", "row").alias("place")] if place else []
    found = [null_if_in(F.col(c), null_tokens).alias(c) for c in columns]
    return raw.select(*found, *[p.alias(place) for p in at])


def _place() -> list[Column]:
    return [
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        )
    ]


def _lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Lines with their place: ``line``, ``file``, ``block`` and ``row``."""
    return (
        spark.read.text(paths)
        .select(F.col("value").alias("line"), *[p.alias("place") for p in _place()])
        .select("line", "place.*")
    )


def _headers(lines: DataFrame) -> DataFrame:
    """The first line of every file that is not blank: ``file``, ``header``, ``row``.

    It stands in the file's first block, unless blank lines fill that; the
    tasks that read it find it, one row a file.
    """
    first = F.min_by(F.struct("line", "block", "row"), F.struct("block", "row"))
    return (
        lines.where("trim(line) <> ''")
        .groupBy("file")
        .agg(first.alias("first"))
        .select(
            "file",
            F.col("first.line").alias("header"),
            F.col("first.block").alias("header_block"),
            F.col("first.row").alias("header_row"),
        )
    )


def _by_own_header(
    lines: DataFrame, headers: DataFrame, columns: Sequence[str], width: int, count: int
) -> DataFrame:
    """Rows with ``columns`` by each file's header, and their places."""
    kinds = ", ".join(f"c{i} string" for i in range(width))
    options = {"escape": '"'}

    def cells(line: str) -> Column:
        row = F.from_csv(line, kinds, options)
        return F.array(*[row[f"c{i}"] for i in range(width)])

    names = cells("header")
    placed = headers.withColumns(
        {f"at{i}": F.array_position(names, c) for i, c in enumerate(columns)}
    )
    ends = [f"at{i}" for i in range(len(columns))]
    broken = placed.where(F.least(F.lit(1), *ends) == 0).limit(3).collect()
    if broken:
        wrong = [(r["file"], r["header"]) for r in broken]
        raise ValueError(f"columns of {list(columns)} are missing in {wrong}")
    places = placed.drop("header")
    body = (
        lines.join(F.broadcast(places), "file")
        if count <= _BROADCAST_FILES
        else lookup_join(lines, places, ["file"], "inner")
    )
    header = (F.col("block") == F.col("header_block")) & (F.col("row") == F.col("header_row"))
    return (
        body.where(~header & (F.trim("line") != ""))
        .withColumn("cells", cells("line"))
        .select(
            *[F.element_at("cells", F.col(f"at{i}").cast("int")).alias(c)
              for i, c in enumerate(columns)],
            "file", "block", "row",
        )
    )


def read_json(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Sequence[str],
    layout: str = "lines",
    per_line: bool = False,
) -> DataFrame:
    """JSON text columns from one of three layouts.

    ``lines``: one object per line. ``records``: a document is an array of
    objects. ``columns``: a document is an object of column objects,
    ``{"a": {"0": ..}, "b": {"0": ..}}``. In the last two a document is a whole
    file, which is split among tasks all the same, or with ``per_line`` a line.
    """
    if layout not in ("lines", "records", "columns"):
        raise ValueError(f"unknown layout {layout!r}")
    if layout != "lines" and not per_line:
        read = json_split.read_records if layout == "records" else json_split.read_columns
        return read(spark, paths, columns)
    reader = spark.read.option("primitivesAsString", True)
    if layout in ("lines", "records"):
        schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
        return reader.schema(schema).json(paths)
    cells = T.MapType(T.StringType(), T.StringType())
    schema = T.StructType([T.StructField(c, cells) for c in columns])
    documents = (
        reader.schema(schema)
        .json(paths)
        .select(F.monotonically_increasing_id().alias("doc"), *columns)
    )

    def cells_of(name: str) -> Column:
        return F.transform(
            F.coalesce(F.map_entries(name), F.array()),
            lambda cell: F.struct(
                cell["key"].alias("row"),
                F.lit(name).alias("column"),
                cell["value"].alias("value"),
            ),
        )

    entries = F.flatten(F.array(*[cells_of(c) for c in columns]))
    # (doc, row) is unique per column, so regrouping cannot skew.
    return (
        documents.select("doc", F.inline(entries))
        .groupBy("doc", "row")
        .agg(
            *[F.max(F.when(F.col("column") == c, F.col("value"))).alias(c) for c in columns]
        )
        .select(*columns)
    )


def write_predictions(predictions: DataFrame, order_by: Sequence[str], path: str) -> None:
    """Header-less one-column boolean CSV in the order of ``order_by``.

    The parts are range-partitioned: read in name order they give the input
    order, and no single task has to write everything.
    """
    (
        predictions.orderBy(*order_by)
        .select(F.col("prediction").cast("boolean").alias("label"))
        .write.option("header", False)
        .csv(path)
    )


def write_report(report: DataFrame, path: str, fmt: str = "csv") -> None:
    """A result table with its header."""
    report.write.mode("overwrite").option("header", True).format(fmt).save(path)
