"""Append, upsert and insert-ignore on keyed tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.operators.dedupe import keep_one

AUDIT_DEFAULT = {"audit_time": F.current_timestamp}


def conform(
    staged: DataFrame, target: DataFrame, defaults: Mapping[str, object] | None = None
) -> DataFrame:
    """``staged`` with the columns and types of ``target``.

    A missing column takes its default (a value, or a function that returns a
    Column), else null.
    """
    defaults = AUDIT_DEFAULT if defaults is None else defaults

    def fill(name: str) -> Column:
        if name in staged.columns:
            return F.col(name)
        default = defaults.get(name)
        return default() if callable(default) else F.lit(default)

    return staged.select(
        *[fill(f.name).cast(f.dataType).alias(f.name) for f in target.schema]
    )


def append(
    target: DataFrame, staged: DataFrame, defaults: Mapping[str, object] | None = None
) -> DataFrame:
    """All rows of both, missing staged columns filled with their defaults."""
    return target.unionByName(conform(staged, target, defaults))


def upsert(
    target: DataFrame,
    staged: DataFrame,
    key: Sequence[str],
    update_cols: Sequence[str],
    order_by: Sequence[str],
    *,
    keep: str = "first",
    defaults: Mapping[str, object] | None = None,
) -> DataFrame:
    """Insert new keys; on existing keys overwrite ``update_cols`` only.

    Conflicts inside the batch are settled first (``keep`` by ``order_by``), so
    both sides are unique on ``key`` and the join cannot skew. A staged null
    overwrites: presence is a flag, not a coalesce. A null key matches nothing;
    take such rows out with ``null_violations`` first.
    """
    key = list(key)
    one = conform(keep_one(staged, key, order_by, keep), target, defaults)
    renamed = one.select(
        *key,
        *[F.col(c).alias(f"__s_{c}") for c in target.columns if c not in key],
        F.lit(True).alias("__staged"),
    )
    both = target.withColumn("__old", F.lit(True)).join(renamed, key, "full_outer")

    def merged(name: str) -> Column:
        if name in key:
            return F.col(name)
        new = F.col(f"__s_{name}")
        if name in update_cols:
            takes_new = F.col("__staged").isNotNull()
        else:
            takes_new = F.col("__old").isNull()
        return F.when(takes_new, new).otherwise(F.col(name)).alias(name)

    return both.select(*[merged(c) for c in target.columns])


def new_rows(
    target: DataFrame,
    staged: DataFrame,
    key: Sequence[str],
    order_by: Sequence[str],
    defaults: Mapping[str, object] | None = None,
) -> DataFrame:
    """The staged rows, one per key, whose key ``target`` does not hold yet."""
    key = list(key)
    one = keep_one(staged, key, order_by)
    return conform(
        one.join(target.select(*key), key, "left_anti"), target, defaults
    )


def insert_ignore(
    target: DataFrame,
    staged: DataFrame,
    key: Sequence[str],
    order_by: Sequence[str],
    defaults: Mapping[str, object] | None = None,
) -> DataFrame:
    """``target`` and the new keys of ``staged``; existing rows stay as they are."""
    return target.unionByName(new_rows(target, staged, key, order_by, defaults))
