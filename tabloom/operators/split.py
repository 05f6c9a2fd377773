"""Reproducible splits by a hash of the key.

The side of a row depends on its key and the seed alone: not on partitioning,
retries, or the rows around it. MD5 gives the same split in any engine.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BUCKETS = 10_000


def hash_bucket(key: Sequence[str], seed: int, buckets: int = _BUCKETS) -> Column:
    """A number in [0, buckets) from the key and the seed."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in key])
    high = F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("bigint")
    return F.pmod(high, F.lit(buckets)).cast("int")


def hash_split(
    df: DataFrame,
    key: Sequence[str],
    shares: Sequence[float] = (0.8, 0.2),
    names: Sequence[str] = ("train", "test"),
    seed: int = 42,
    column: str = "split",
) -> DataFrame:
    """Add the name of each row's part; the parts are disjoint and cover all."""
    if not math.isclose(sum(shares), 1.0, abs_tol=1e-9):
        raise ValueError(f"shares must sum to 1, got {sum(shares)}")
    if column in df.columns:
        raise ValueError(f"column {column!r} exists: drop it to split anew")
    bucket = hash_bucket(key, seed)
    edges = [round(sum(shares[: i + 1]) * _BUCKETS) for i in range(len(shares))]
    part = F.lit(names[-1])
    for name, edge in list(zip(names, edges))[-2::-1]:
        part = F.when(bucket < edge, name).otherwise(part)
    return df.withColumn(column, part)


def fold_column(
    df: DataFrame, key: Sequence[str], folds: int = 5, seed: int = 42
) -> DataFrame:
    """Add ``fold`` in [0, folds) for cross-validation."""
    return df.withColumn("fold", hash_bucket(key, seed, folds))
