"""Primary-key, foreign-key and not-null checks as result tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.operators.skew import lookup_join


def pk_violations(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once or hold a null."""
    has_null = F.lit(False)
    for name in key:
        has_null = has_null | F.col(name).isNull()
    return (
        df.groupBy(*key)
        .agg(F.count("*").alias("n_rows"))
        .where((F.col("n_rows") > 1) | has_null)
    )


def null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a null in any of the columns."""
    broken = F.lit(False)
    for name in columns:
        broken = broken | F.col(name).isNull()
    return df.where(broken)


def fk_accepted(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows of ``child`` whose key exists in ``parent`` (unique on key)."""
    return lookup_join(child, parent.select(key), [key], "left_semi")


def fk_orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows of ``child`` whose key is missing in ``parent``."""
    return lookup_join(child, parent.select(key), [key], "left_anti")
