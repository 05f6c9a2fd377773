"""Joins of a large many-side to a lookup side that has one row per key.

One key may hold a third of the many-side. Adaptive execution splits such a
partition at run time from its measured size, at no cost when nothing is
skewed, so that is the first choice. It only does so when both sides arrive
through an exchange made for the join and nothing above needs the join's
partitioning; ``lookup_join`` sees to the first, its callers to the second.
Where a session has it switched off, the hot keys are found with
a mergeable frequent-items sketch (one narrow pass, no shuffle by key), split
into as many salts as their row count asks for, and only their lookup rows are
repeated. The sketch decides speed only: any set of hot keys gives the same
rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Hot keys are broadcast. A key is hot beyond ``ROWS_PER_SALT`` rows, or a greater
# number that leaves no more than this many of them: fewer than ``rows / limit``
# keys can have more than ``limit`` rows, and the sketch tracks all of those.
MAX_HOT_KEYS = 20_000
ROWS_PER_SALT = 2_000_000

_HASH, _SALTS, _SALT = "__key_hash", "__salts", "__salt"


def hot_keys(
    df: DataFrame, keys: Sequence[str], rows_per_salt: int = ROWS_PER_SALT
) -> DataFrame:
    """Hashes of all keys with more than ``rows_per_salt`` rows, and their salts."""
    rows = df.count()
    limit = max(rows_per_salt, -(-rows // MAX_HOT_KEYS))
    most = max(1, rows // limit)
    # A sketch of n counters errs by less than rows / n.
    tracked = min(1_000_000, 20 * most + 1_000)
    sketch = df.select(F.xxhash64(*keys).alias(_HASH)).agg(
        F.expr(f"approx_top_k({_HASH}, {most}, {tracked})").alias("top")
    )
    return (
        sketch.select(F.inline("top"))
        .where(F.col("count") > limit)
        .select(
            F.col("item").alias(_HASH),
            F.ceil(F.col("count") / limit).cast("int").alias(_SALTS),
        )
    )


def splits_skew(spark: SparkSession) -> bool:
    """Whether adaptive execution splits skewed join partitions here."""
    return all(
        spark.conf.get(name, "true") == "true"
        for name in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled")
    )


def lookup_join(
    many: DataFrame, lookup: DataFrame, on: Sequence[str], how: str = "left"
) -> DataFrame:
    """Join ``many`` to ``lookup`` (unique on ``on``), hot keys split.

    ``how`` is inner, left, left_semi or left_anti. A lookup grouped by the key
    is already partitioned by it and would be joined without an exchange, which
    rules the split out; a second key derived from the first brings it back.
    """
    if not splits_skew(many.sparkSession):
        return salted_join(many, lookup, on, how)
    # Six bits, and never null: the planner would add a filter for a null.
    derived = F.shiftrightunsigned(F.hash(*on), 26)
    return (
        many.withColumn(_HASH, derived)
        .join(lookup.withColumn(_HASH, derived), [*on, _HASH], how)
        .drop(_HASH)
    )


def salted_join(
    many: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str = "left",
    *,
    rows_per_salt: int = ROWS_PER_SALT,
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """The same join with the hot keys of ``many`` salted explicitly.

    The salt is a hash of the row itself (``spread_by``, by default all
    columns), never ``rand()``: a re-run task must send its rows to the same
    place.
    """
    on = list(on)
    hot = F.broadcast(hot_keys(many, on, rows_per_salt))
    spread = list(spread_by or many.columns)
    salted = (
        many.withColumn(_HASH, F.xxhash64(*on))
        .join(hot, _HASH, "left")
        .withColumn(
            _SALT,
            F.coalesce(
                F.pmod(F.xxhash64(*spread), F.col(_SALTS)).cast("int"), F.lit(0)
            ),
        )
        .drop(_HASH, _SALTS)
    )
    repeated = (
        lookup.withColumn(_HASH, F.xxhash64(*on))
        .join(hot, _HASH, "left")
        .withColumn(
            _SALT,
            F.explode(
                F.sequence(F.lit(0), F.coalesce(F.col(_SALTS), F.lit(1)) - 1)
            ),
        )
        .drop(_HASH, _SALTS)
    )
    return salted.join(repeated, [*on, _SALT], how).drop(_SALT)
