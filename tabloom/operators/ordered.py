"""Total orders, running totals and exact quantiles without a one-task window.

The rows are range-partitioned on the full order, so even a single huge group
is spread over many partitions. Each partition is numbered on its own and the
groups that cross a partition border get the carried-over total of the earlier
partitions; at most two groups per partition touch a border, which bounds
everything that is broadcast here.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.session import materialize

_PART, _POS = "__part", "__pos"
# monotonically_increasing_id keeps the row's position in the low 33 bits.
_POSITION_BITS = (1 << 33) - 1


def _range_sorted(df: DataFrame, keys: Sequence[str | Column], partitions: int | None):
    """``df`` in global order, stored, with its partition number and position.

    Without a number the session's shuffle partitions are the upper limit and
    adaptive execution merges small ones; either way the numbers are stored.
    """
    ranged = (
        df.repartitionByRange(*([partitions] if partitions else []), *keys)
        .sortWithinPartitions(*keys)
        .withColumn(_PART, F.spark_partition_id())
        .withColumn(_POS, F.monotonically_increasing_id())
    )
    return materialize(ranged, "ordered")


def number_rows(
    df: DataFrame,
    order_by: Sequence[str],
    name: str = "row_num",
    partitions: int | None = None,
) -> DataFrame:
    """Dense numbers 1..n in the order of ``order_by`` (unique over rows)."""
    rows = _range_sorted(df, order_by, partitions)
    counts = rows.groupBy(_PART).agg(F.count("*").alias("__n"))
    carried = counts.select(
        _PART,
        F.coalesce(
            F.sum("__n").over(
                Window.partitionBy(F.lit(0))
                .orderBy(_PART)
                .rowsBetween(Window.unboundedPreceding, -1)
            ),
            F.lit(0),
        ).alias("__carried"),
    )  # one row per partition
    local = F.col(_POS).bitwiseAND(F.lit(_POSITION_BITS))
    return (
        rows.join(F.broadcast(carried), _PART)
        .withColumn(name, F.col("__carried") + local + 1)
        .drop(_PART, _POS, "__carried")
    )


def running_total(
    df: DataFrame,
    order_by: Sequence[str],
    partition_by: Sequence[str] = (),
    weight: str | None = None,
    name: str = "before",
    total: str | None = None,
    partitions: int | None = None,
    needed: Callable[[Column, Column, Column], Column] | None = None,
) -> DataFrame:
    """Add the total weight (or row count) of the earlier rows of the group.

    Same result as ``sum(weight) OVER (PARTITION BY .. ORDER BY .. ROWS BETWEEN
    UNBOUNDED PRECEDING AND 1 PRECEDING)`` with 0 for the first row, but no
    group has to fit into one task. ``order_by`` must be unique inside a group.
    ``total`` names a further column with the weight of the whole group.

    ``needed`` gets a stretch of a group (its first running total, the next one
    after it, the group's total) and says whether the caller wants its rows;
    the other stretches are dropped before the windows, as far as whole
    partitions go.
    """
    groups = list(partition_by)
    rows = _range_sorted(df, [*groups, *order_by], partitions)
    amount = F.col(weight) if weight else F.lit(1).cast("long")

    chunks = rows.groupBy(_PART, *groups).agg(
        F.sum(amount).alias("__sum"),
        F.min(_POS).alias("__first"),
        F.max(_POS).alias("__last"),
    )
    if groups:
        # A group that spans partitions touches a border in each of them, so the
        # border chunks hold all its rows: at most two chunks per partition.
        border = rows.groupBy(_PART).agg(
            F.min(_POS).alias("__head"), F.max(_POS).alias("__tail")
        )
        chunks = chunks.join(F.broadcast(border), _PART).where(
            (F.col("__first") == F.col("__head")) | (F.col("__last") == F.col("__tail"))
        )
    whole = Window.partitionBy(*(groups or [F.lit(0)]))
    carried = chunks.select(
        F.col(_PART).alias("__cpart"),
        *[F.col(g).alias(f"__c_{g}") for g in groups],
        F.coalesce(
            F.sum("__sum").over(
                whole.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
            ),
            F.lit(0),
        ).alias("__carried"),
        F.col("__sum").alias("__chunk_sum"),
        F.sum("__sum").over(whole).alias("__group"),
    )
    same = F.col(_PART) == F.col("__cpart")
    for g in groups:
        same = same & F.col(g).eqNullSafe(F.col(f"__c_{g}"))
    if needed:
        low = F.col("__carried")
        unwanted = carried.where(~needed(low, low + F.col("__chunk_sum"), F.col("__group")))
        rows = rows.join(F.broadcast(unwanted), same, "left_anti")

    chunk = Window.partitionBy(_PART, *groups)
    if weight:
        earlier = chunk.orderBy(_POS).rowsBetween(Window.unboundedPreceding, -1)
        within = F.coalesce(F.sum(amount).over(earlier), F.lit(0))
    else:
        within = (F.row_number().over(chunk.orderBy(_POS)) - 1).cast("long")
    local = rows.withColumn("__within", within)
    if total:
        local = local.withColumn("__chunk", F.sum(amount).over(chunk))

    carried = carried.drop("__chunk_sum")
    out = local.join(F.broadcast(carried), same, "left").withColumn(
        name, F.col("__within") + F.coalesce("__carried", F.lit(0))
    )
    if total:
        out = out.withColumn(total, F.coalesce("__group", "__chunk"))
    return out.select(*df.columns, name, *([total] if total else []))


def quantiles(
    df: DataFrame,
    value: str,
    probabilities: dict[str, float],
    group_by: Sequence[str] = (),
    weight: str | None = None,
) -> DataFrame:
    """Exact interpolating quantiles, one row per group, one column per name.

    Equal values are merged before the shuffle, so a hot value is one row; the
    remaining distinct values are ranked by ``running_total``. A weight counts
    a row that many times. Null values are left out.
    """
    groups = list(group_by)
    amount = F.sum(weight) if weight else F.count("*")

    def ranks(size: Column) -> list[Column]:
        return [
            edge((size - 1) * F.lit(float(p)))
            for p in probabilities.values()
            for edge in (F.floor, F.ceil)
        ]

    def holds_a_rank(low: Column, high: Column, size: Column) -> Column:
        return reduce(Column.__or__, [(low <= r) & (r < high) for r in ranks(size)])

    ranked = running_total(
        df.dropna(subset=[value])
        .groupBy(*groups, value)
        .agg(amount.cast("long").alias("__freq")),
        order_by=[value],
        partition_by=groups,
        weight="__freq",
        name="__before",
        total="__n",
        needed=holds_a_rank,
    )

    def holds(rank: Column) -> Column:
        return (F.col("__before") <= rank) & (
            rank < F.col("__before") + F.col("__freq")
        )

    picks = []
    for name, p in probabilities.items():
        at = (F.col("__n") - 1) * F.lit(float(p))
        picks += [
            F.max(F.when(holds(F.floor(at)), F.col(value))).alias(f"__lo_{name}"),
            F.max(F.when(holds(F.ceil(at)), F.col(value))).alias(f"__hi_{name}"),
            F.max(at - F.floor(at)).alias(f"__at_{name}"),
        ]
    picked = ranked.groupBy(*groups).agg(*picks)
    return picked.select(
        *groups,
        *[
            (
                F.col(f"__lo_{n}")
                + (F.col(f"__hi_{n}") - F.col(f"__lo_{n}")) * F.col(f"__at_{n}")
            )
            .cast("double")
            .alias(n)
            for n in probabilities
        ],
    )


def rounded_value(value: Column, error: float) -> Column:
    """The nearest of a scale of values that are a fixed ratio apart.

    It differs from ``value`` by at most ``error`` times its size.
    """
    ratio = math.log((1 + error) / (1 - error))
    size = F.abs(value)
    step = F.ceil(F.log(size) / ratio)
    middle = F.exp(step * ratio) * (1 - error)
    return F.when(size == 0, F.lit(0.0)).otherwise(F.signum(value) * middle)


def quantile_sketch(
    df: DataFrame,
    columns: Sequence[str],
    error: float = 0.01,
    group_by: Sequence[str] = (),
    weight: str | None = None,
) -> DataFrame:
    """Weights of rounded values: ``field``, the groups, ``value`` and ``weight``.

    All doubles round to some 140,000 values at one per cent, so a sketch has a
    bounded size however many rows it stands for. Sketches of parts are merged by
    a union, ``sketch_quantiles`` adds their weights up.
    """
    cells = [
        F.struct(
            F.lit(c).alias("field"),
            rounded_value(F.col(c).cast("double"), error).alias("value"),
        )
        for c in columns
    ]
    amount = F.sum(weight) if weight else F.count("*")
    kept = [*group_by, *([weight] if weight else [])]
    return (
        df.select(*kept, F.inline(F.array(*cells)))
        .where("value is not null")
        .groupBy("field", *group_by, "value")
        .agg(amount.cast("long").alias("weight"))
    )


def sketch_quantiles(
    sketch: DataFrame, probabilities: dict[str, float], group_by: Sequence[str] = ()
) -> DataFrame:
    """Quantiles of one or several sketches; each value within the sketch's error."""
    return quantiles(sketch, "value", probabilities, ["field", *group_by], "weight")


def column_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: dict[str, float],
    group_by: Sequence[str] = (),
    weight: str | None = None,
    error: float | None = None,
) -> DataFrame:
    """Quantiles of several numeric columns in one pass, a ``field`` per row.

    Exact, or with ``error`` from a sketch of bounded size.
    The columns travel by number: an int sorts faster than a name.
    """
    if error:
        sketch = quantile_sketch(df, columns, error, group_by, weight)
        return sketch_quantiles(sketch, probabilities, group_by)
    cells = [
        F.struct(F.lit(i).alias("__field"), F.col(c).cast("double").alias("__value"))
        for i, c in enumerate(columns)
    ]
    kept = [*group_by, *([weight] if weight else [])]
    out = quantiles(
        df.select(*kept, F.inline(F.array(*cells))),
        "__value",
        probabilities,
        ["__field", *group_by],
        weight,
    )
    names = F.array(*[F.lit(c) for c in columns])
    return out.select(
        F.get(names, F.col("__field")).alias("field"), *group_by, *probabilities
    )
