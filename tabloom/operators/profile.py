"""Exploratory aggregates: the numbers behind each table view and chart."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.operators.ordered import column_quantiles


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first, nulls left out."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "value")
    )


def degree_distribution(bridge: DataFrame, node: str, other: str) -> DataFrame:
    """How many nodes have how many rows (non-null on the other side)."""
    return (
        bridge.where(F.col(node).isNotNull())
        .groupBy(node)
        .agg(F.count(other).alias("degree"))
        .groupBy("degree")
        .agg(F.count("*").alias("n_nodes"))
    )


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls per column, all columns in one pass."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    cells = [
        F.struct(F.lit(c).alias("field"), F.col(c).alias("n_null")) for c in df.columns
    ]
    return counted.select(F.inline(F.array(*cells)))


def shape(df: DataFrame) -> DataFrame:
    """One row: number of rows and of columns."""
    return df.agg(
        F.count("*").alias("n_rows"), F.lit(len(df.columns)).alias("n_columns")
    )


def correlation(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every column pair, one aggregate, long form."""
    pairs = [*combinations(columns, 2), *[(c, c) for c in columns]]

    def number(name: str) -> Column:
        kind = dict(df.dtypes)[name]
        column = F.col(name)
        return (column.cast("int") if kind == "boolean" else column).cast("double")

    measured = df.agg(*[F.corr(number(a), number(b)).alias(f"{a}|{b}") for a, b in pairs])
    cells = []
    for a, b in pairs:
        r = F.col(f"`{a}|{b}`")
        for x, y in dict.fromkeys([(a, b), (b, a)]):
            cells.append(
                F.struct(F.lit(x).alias("a"), F.lit(y).alias("b"), r.alias("r"))
            )
    return measured.select(F.inline(F.array(*cells)))


def automatic_bins(df: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    """Equal-width bins per column from its rows, range and quartiles.

    The smaller of the Freedman-Diaconis and Sturges widths, as plotting
    libraries take it; Sturges alone where the quartiles are equal.
    """
    number = {c: F.col(c).cast("double") for c in columns}
    bounds = df.agg(
        *[F.count(c).alias(f"n_{c}") for c in columns],
        *[(F.max(number[c]) - F.min(number[c])).alias(f"range_{c}") for c in columns],
    ).first()
    quartiles = {
        r["field"]: r["high"] - r["low"]
        for r in column_quantiles(df, columns, {"low": 0.25, "high": 0.75}).collect()
    }  # a row per column
    found = {}
    for c in columns:
        n, span = bounds[f"n_{c}"], bounds[f"range_{c}"]
        if not n or not span:
            found[c] = 1
            continue
        sturges = span / (math.log2(n) + 1)
        spread = 2 * quartiles[c] / n ** (1 / 3)
        found[c] = math.ceil(span / (min(spread, sturges) if spread else sturges))
    return found


def histogram(df: DataFrame, columns: Sequence[str], bins: int | str = 50) -> DataFrame:
    """Equal-width bins per column: field, bin, lower edge and row count.

    ``bins`` may be ``auto``, see ``automatic_bins``. The bounds come from one
    aggregate and enter as scalar values.
    """
    if bins == "auto":
        counts = automatic_bins(df, columns)
    else:
        counts = dict.fromkeys(columns, bins)
    bounds = df.agg(
        *[F.min(F.col(c).cast("double")).alias(f"lo_{c}") for c in columns],
        *[F.max(F.col(c).cast("double")).alias(f"hi_{c}") for c in columns],
    )

    def cell(c: str):
        low, high = bounds.select(f"lo_{c}").scalar(), bounds.select(f"hi_{c}").scalar()
        width = (high - low) / counts[c]
        at = F.floor(F.try_divide(F.col(c).cast("double") - low, width))
        # The maximum belongs to the last bin; a constant column has one bin.
        bin_no = F.least(F.coalesce(at, F.lit(0)), F.lit(counts[c] - 1)).cast("int")
        return F.struct(
            F.lit(c).alias("field"),
            F.when(F.col(c).isNotNull(), bin_no).alias("bin"),
            (low + bin_no * width).alias("bin_start"),
        )

    return (
        df.select(F.inline(F.array(*[cell(c) for c in columns])))
        .where(F.col("bin").isNotNull())
        .groupBy("field", "bin", "bin_start")
        .agg(F.count("*").alias("n"))
    )


def class_quantiles(
    df: DataFrame, columns: Sequence[str], label: str, error: float | None = None
) -> DataFrame:
    """Per column and class: count, minimum, quartiles, maximum.

    Exact, or with ``error`` the quartiles from a sketch, each within that share
    of the value (see ``ordered.quantile_sketch``).
    """
    known = df.where(F.col(label).isNotNull())
    limits = known.groupBy(label).agg(
        *[F.count(c).alias(f"n_{c}") for c in columns],
        *[F.min(F.col(c).cast("double")).alias(f"min_{c}") for c in columns],
        *[F.max(F.col(c).cast("double")).alias(f"max_{c}") for c in columns],
    )
    cells = [
        F.struct(
            F.lit(c).alias("field"),
            *[F.col(f"{name}_{c}").alias(name) for name in ("n", "min", "max")],
        )
        for c in columns
    ]
    quartiles = column_quantiles(
        known, columns, {"q25": 0.25, "median": 0.5, "q75": 0.75}, [label], error=error
    )
    return limits.select(label, F.inline(F.array(*cells))).join(
        quartiles, ["field", label], "left"
    )


def scatter_points(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The points of a scatter matrix: every row, these columns only."""
    return df.select(*columns)


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """One row: the share of true labels among the labelled rows."""
    return df.agg(
        F.try_divide(F.sum(F.col(label).cast("int")), F.count(label)).alias("share_true")
    )


def top_n(df: DataFrame, order_by: Sequence[str | Column], n: int) -> DataFrame:
    """The first ``n`` rows of an order: a top-k report."""
    return df.orderBy(*order_by).limit(n)


def stack(parts: dict[str, DataFrame], name: str) -> DataFrame:
    """Union of equal-schema results with the part's name in ``name``."""
    return reduce(
        DataFrame.unionByName,
        [part.withColumn(name, F.lit(key)) for key, part in parts.items()],
    )
