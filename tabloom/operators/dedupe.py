"""Duplicate rows and duplicate groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabloom.operators.ordered import running_total
from tabloom.session import materialize

_CONTENT = "__content"


LARGE_GROUP = 1_000_000  # rows of equal content that one task may number


def duplicate_rows(
    df: DataFrame,
    content: Sequence[str],
    order_by: Sequence[str],
    large: int = LARGE_GROUP,
) -> DataFrame:
    """Rows after the first of each equal-content group, with their number.

    ``order_by`` ends in a unique column: rows of one load share a timestamp.

    Contents are counted by hash first; rows without a partner go no further.
    Groups of more than ``large`` rows are numbered over many tasks; there are
    at most ``1 / large`` of the rows of those, the others fit into a task each.
    """
    hashed = df.withColumn(_CONTENT, F.xxhash64(*content))
    counts = materialize(
        hashed.groupBy(_CONTENT).agg(F.count("*").alias("__n")).where("__n > 1"),
        "content-counts",
    )
    few = hashed.join(counts.where(F.col("__n") <= large).select(_CONTENT), _CONTENT, "left_semi")
    group = Window.partitionBy(_CONTENT, *content).orderBy(*order_by)
    numbered = (
        few.withColumn("row_num", F.row_number().over(group).cast("long"))
        .where(F.col("row_num") > 1)
        .drop(_CONTENT)
    )
    huge = counts.where(F.col("__n") > large).select(_CONTENT)
    if huge.isEmpty():
        return numbered
    many = hashed.join(F.broadcast(huge), _CONTENT, "left_semi").drop(_CONTENT)
    spread = (
        running_total(many, order_by, partition_by=content, name="__before")
        .where(F.col("__before") > 0)
        .withColumn("row_num", F.col("__before") + 1)
        .drop("__before")
    )
    return numbered.unionByName(spread)


def keep_one(
    df: DataFrame,
    key: Sequence[str],
    order_by: Sequence[str],
    keep: str = "first",
) -> DataFrame:
    """The first (or last) row per key.

    An aggregate, not a window: each task reduces its part of a hot key before
    the shuffle.
    """
    rest = [c for c in df.columns if c not in key]
    pick = F.min_by if keep == "first" else F.max_by
    best = pick(F.struct(*rest), F.struct(*order_by)).alias("__row")
    return df.groupBy(*key).agg(best).select(*key, "__row.*").select(*df.columns)


def duplicate_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Groups that occur more than once, nulls grouped together."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def duplicate_group_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: the number of groups (not of surplus rows)."""
    return duplicate_groups(df, keys).agg(F.count("*").alias("duplicate_count"))
