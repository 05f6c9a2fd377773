"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import Scratch
from tabloom.operators.skew import lookup_join


def connected_components(edges: DataFrame) -> DataFrame:
    """Distributed union-find: alternating large and small stars.

    ``edges`` has two long columns ``a`` and ``b``, never null; order,
    repetitions and loops do not matter. Returns ``node`` and ``component``
    (smallest node reachable) for every node with an edge to another one.
    A round is joins and minima over the edge list, never a list of
    neighbours, so that a node may have any number of links, and one with many
    is split among tasks; each round is
    stored, and the number of rounds grows with the logarithm of the size.
    """
    scratch = Scratch(edges.sparkSession)
    stars = scratch.store(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "round-0",
    )
    state, rounds = _state(stars), 0
    while True:
        rounds += 1
        stars = scratch.store(_small_star(_large_star(stars)), f"round-{rounds}")
        scratch.drop(f"round-{rounds - 1}")
        before, state = state, _state(stars)
        if state == before:
            heads = stars.select(F.col("v").alias("u"), "v").distinct()
            return stars.unionByName(heads).toDF("node", "component")


def _state(stars: DataFrame) -> tuple:
    mixed = F.xxhash64("u", "v")
    return tuple(
        stars.agg(
            F.count("*"), F.sum(F.shiftright(mixed, 20)), F.bit_xor(mixed)
        ).collect()[0]
    )


def _large_star(stars: DataFrame) -> DataFrame:
    """Larger neighbours move to the smallest neighbour."""
    both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return (
        lookup_join(both.where("v > u"), least, ["u"], "inner")
        .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        .distinct()
    )


def _small_star(stars: DataFrame) -> DataFrame:
    """Smaller neighbours and the node itself move to the smallest of them."""
    least = stars.groupBy("u").agg(F.min("v").alias("m"))
    moved = (
        lookup_join(stars, least, ["u"], "inner")
        .where("v <> m")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
    )
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
