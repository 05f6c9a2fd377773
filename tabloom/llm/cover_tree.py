"""Embedding near-duplicates: cover trees, two of which are descended together."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import (
    id_key,
    id_value,
    local_components,
    materialize,
    release,
    sorted_groups,
)
from tabloom.llm.components import connected_components
from tabloom.operators.skew import lookup_join

BLOCK = 4096  # vectors of one tree
_LEAF = 48
_SLACK = 1e-7  # chord lengths of unit vectors are rounded


@dataclass
class Node:
    """Members lie within ``radius`` of the centre; children halve the level's radius."""

    center: int
    radius: float
    members: np.ndarray
    children: list[Node] = field(default_factory=list)
    centers: np.ndarray = None  # of the children
    radii: np.ndarray = None


def chords(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of unit vectors, every row of ``a`` to every row of ``b``."""
    return np.sqrt(np.maximum(0, 2 - 2 * (a @ b.T)))


def build(x: np.ndarray) -> Node:
    """A cover tree over unit vectors: nested centres, radii 2, 1, 1/2, ..."""
    everything = np.arange(len(x))
    distances = chords(x, x[:1])[:, 0]
    root = Node(0, float(distances.max()), everything)
    stack = [(root, 1.0, distances)]
    while stack:
        node, level, distances = stack.pop()
        if len(node.members) <= _LEAF or node.radius <= _SLACK:
            continue
        while level >= node.radius:
            level /= 2
        left, center, near = node.members, node.center, distances
        while True:  # the node's own centre comes first: levels are nested
            inside = near <= level
            child = Node(center, float(near[inside].max()), left[inside])
            node.children.append(child)
            stack.append((child, level / 2, near[inside]))
            left = left[~inside]
            if not len(left):
                break
            center = int(left[0])
            near = chords(x[left], x[center : center + 1])[:, 0]
        node.centers = np.array([c.center for c in node.children])
        node.radii = np.array([c.radius for c in node.children])
    return root


def linked(
    x: np.ndarray, y: np.ndarray, cosine: float, same: bool
) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (row of ``x``, row of ``y``) of unit vectors with that cosine or more.

    Both trees are descended together. A pair of nodes is dropped when their
    centres are farther apart than the threshold and both covering radii; what
    is left at the leaves is verified. ``same``: both are one set, each pair
    is given once and no vector with itself.
    """
    reach = np.sqrt(2 - 2 * cosine) + _SLACK
    a, b = build(x), None
    b = a if same else build(y)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    stack = [(a, b)]
    while stack:
        left, right = stack.pop()
        if not left.children and not right.children:
            i, j = np.nonzero(x[left.members] @ y[right.members].T >= cosine)
            i, j = left.members[i], right.members[j]
            if same and left is right:
                i, j = i[i < j], j[i < j]
            found.append((i, j))
            continue
        lefts = left.children or [left]
        rights = right.children or [right]
        lc = left.centers if left.children else np.array([left.center])
        rc = right.centers if right.children else np.array([right.center])
        lr = left.radii if left.children else np.array([left.radius])
        rr = right.radii if right.children else np.array([right.radius])
        near = chords(x[lc], y[rc]) <= reach + lr[:, None] + rr[None, :]
        if same and left is right:
            near = np.triu(near)
        for i, j in zip(*np.nonzero(near), strict=True):
            stack.append((lefts[i], rights[j]))
    return tuple(np.concatenate(p) for p in zip(*found, strict=True))


def _unit(column: pa.ChunkedArray) -> np.ndarray:
    x = np.array(column.to_pylist(), np.float64)
    # The largest component first: squares of the rest cannot overflow.
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _pairs(batches: Iterator[pa.RecordBatch], cosine: float):
    """Per block pair: links of each vector, and a forest of them."""
    for group in sorted_groups(batches, ["cell", "lo", "hi"]):
        names = group.column("rep").to_numpy()
        weights = group.column("copies").to_numpy()
        part = group.column("part").to_numpy()
        lo, hi = group.column("lo")[0].as_py(), group.column("hi")[0].as_py()
        x = _unit(group.column("vector"))
        if lo == hi:
            i, j = linked(x, x, cosine, same=True)
        else:
            one, two = np.flatnonzero(part == lo), np.flatnonzero(part == hi)
            if not len(one) or not len(two):
                continue
            i, j = linked(x[one], x[two], cosine, same=False)
            i, j = one[i], two[j]
        links = np.bincount(i, weights[j], len(x)) + np.bincount(j, weights[i], len(x))
        label = local_components(len(x), i, j)
        rows = np.flatnonzero(links)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(names[rows]),
                pa.array(names[label[rows]]),
                pa.array(links[rows].astype(np.int64)),
            ],
            ["a", "b", "links"],
        )


def near_duplicates(
    vectors: DataFrame,
    cosine: float = 0.98,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
) -> DataFrame:
    """Link vectors of one label whose cosine, in double precision, is large enough.

    Returns a row per vector: ``id_column``, ``n_links`` (other vectors linked
    directly), ``component_id`` (smallest id reachable, itself included) and
    ``kept`` (it is that id). Vectors that are null, zero, or hold null or
    non-finite components, and those without a label, link with nothing; nor
    do vectors of different lengths. Null ids are one id, larger than all
    others; rows that repeat an id count as vectors of their own; an empty
    table gives an empty table; other columns are left out.

    Equal vectors of a label are one class. A label's classes are cut into
    blocks by a hash; each pair of blocks is a task with a cover tree on
    either side, so a label of any size is spread. A task passes on the number
    of links of each vector and a forest, never the pairs.
    """
    spark = vectors.sparkSession
    rows = vectors.select(
        id_key(id_column).alias("key"),
        F.col(vector_column).cast("array<double>").alias("vector"),
        F.col(label_column).alias("label"),
    )
    finite = F.forall(
        "vector", lambda v: F.coalesce(F.abs(v) < float("inf"), F.lit(False))
    )
    usable = F.coalesce(
        F.col("label").isNotNull()
        & finite
        & F.exists("vector", lambda v: v != 0),
        F.lit(False),
    )
    good = rows.where(usable).select(
        "key",
        # -0.0 and 0.0 are one value of a vector
        F.transform("vector", lambda v: v + F.lit(0.0)).alias("vector"),
        F.xxhash64("label", F.size("vector")).alias("cell"),
        F.col("label").cast("string").alias("name"),
    )
    same = ["cell", "name", "vector"]
    classes = materialize(
        good.groupBy(*same)
        .agg(F.min("key").alias("rep"), F.count("*").alias("copies"))
        .withColumn("class", F.monotonically_increasing_id()),
        "vector-classes",
    )
    links = materialize(
        _blocks(classes).mapInArrow(
            lambda batches: _pairs(batches, cosine), "a long, b long, links long"
        ),
        "vector-links",
    )
    counted = links.groupBy(F.col("a").alias("class")).agg(F.sum("links").alias("more"))
    components = connected_components(links.select("a", "b"))
    numbered = (
        classes.join(counted, "class", "left")
        .join(components.withColumnRenamed("node", "class"), "class", "left")
        .withColumn("component", F.coalesce("component", "class"))
    )
    heads = numbered.groupBy("component").agg(F.min("rep").alias("head"))
    named = lookup_join(numbered, heads, ["component"], "inner").select(
        *same,
        (F.coalesce("more", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        "head",
    )
    linked_rows = good.join(named, same).select("key", "n_links", "head")
    alone = rows.where(~usable).select(
        "key", F.lit(0).cast("long").alias("n_links"), F.col("key").alias("head")
    )
    release(spark)
    return linked_rows.unionByName(alone).select(
        id_value("key").alias(id_column),
        "n_links",
        id_value("head").alias("component_id"),
        (F.col("key") == F.col("head")).alias("kept"),
    )


def _blocks(classes: DataFrame) -> DataFrame:
    """Rows laid out by pair of blocks of their label (``cell``)."""
    chunks = classes.groupBy("cell", "name").agg(
        F.ceil(F.count("*") / BLOCK).cast("int").alias("chunks")
    )
    placed = (
        classes.join(chunks, ["cell", "name"])
        .withColumn("part", F.pmod(F.xxhash64("class"), "chunks").cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select(
            F.xxhash64("cell", "name").alias("cell"),
            F.col("class").alias("rep"),
            "copies",
            "vector",
            "part",
            F.least("part", "other").alias("lo"),
            F.greatest("part", "other").alias("hi"),
        )
    )
    return placed.repartition("cell", "lo", "hi").sortWithinPartitions(
        "cell", "lo", "hi"
    )
