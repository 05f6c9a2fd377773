"""Target-mean encoding of many-to-many relations into one feature table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.operators.skew import lookup_join
from tabloom.operators.split import hash_bucket

UNSEEN = 0.5


def _is_positive(label: Column) -> Column:
    """1 for a true label, 0 for a false or missing one."""
    return F.when(label, 1).otherwise(0)


def person_scores(
    bridge: DataFrame,
    entities: DataFrame,
    person: str,
    key: str = "movie_id",
    label: str = "label",
) -> DataFrame:
    """Per person the share of its entities with a true label.

    Pass the train rows as ``entities``; a person without any is absent, and
    ``entity_scores`` gives it 0.5.
    """
    marked = entities.select(key, _is_positive(F.col(label)).alias("__positive"))
    joined = lookup_join(bridge.select(person, key), marked, [key], "inner")
    return joined.groupBy(person).agg(F.avg("__positive").alias("avg_score"))


def entity_scores(
    bridge: DataFrame, scores: DataFrame, person: str, key: str = "movie_id"
) -> DataFrame:
    """Per entity the number of persons and the mean of their scores."""
    joined = lookup_join(bridge.select(person, key), scores, [person], "left")
    return joined.groupBy(key).agg(
        F.count(person).alias("person_count"),
        F.avg(F.coalesce("avg_score", F.lit(UNSEEN))).alias("avg_score"),
    )


def leave_out_scores(
    bridge: DataFrame,
    entities: DataFrame,
    person: str,
    key: str = "movie_id",
    label: str = "label",
    subset: str = "subset",
    folds: int | None = None,
    seed: int = 42,
) -> DataFrame:
    """``entity_scores`` in which no train row's own label counts.

    Without ``folds`` a train row's persons are scored by their other train
    rows (leave-one-out), with it by those of the other folds (out-of-fold; a
    fold is a hash of the key). Rows that are not train rows see all of them.
    Sums by person, and by fold, come from one aggregate, and a row's own share
    is subtracted. ``bridge`` must not repeat a pair.
    """
    fold = hash_bucket([key], seed, folds) if folds else F.lit(0)
    marked = entities.select(
        key,
        F.coalesce(F.col(subset) == "train", F.lit(False)).alias("__train"),
        _is_positive(F.col(label)).alias("__positive"),
        fold.alias("__fold"),
    )
    pairs = lookup_join(bridge.select(person, key), marked, [key], "inner")
    parts = range(folds or 1)

    def total(amount: Column, part: int) -> Column:
        here = F.col("__train") & (F.col("__fold") == part)
        return F.coalesce(F.sum(F.when(here, amount)), F.lit(0))

    sums = pairs.groupBy(person).agg(
        F.array(*[total(F.col("__positive"), i) for i in parts]).alias("__sums"),
        F.array(*[total(F.lit(1), i) for i in parts]).alias("__counts"),
    )

    def others(values: str, own_share: Column) -> Column:
        whole = F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)
        share = F.get(values, F.col("__fold")) if folds else own_share
        return whole - F.when(F.col("__train"), share).otherwise(0)

    scored = lookup_join(pairs, sums, [person], "inner").withColumn(
        "__score",
        F.try_divide(
            others("__sums", F.col("__positive")), others("__counts", F.lit(1))
        ),
    )
    return scored.groupBy(key).agg(
        F.count(person).alias("person_count"),
        F.avg(F.coalesce("__score", F.lit(UNSEEN))).alias("avg_score"),
    )


def feature_table(
    entities: DataFrame,
    relations: Mapping[str, tuple[DataFrame, str]],
    key: str = "movie_id",
    label: str = "label",
    subset: str = "subset",
    fill: bool = True,
    leave_out: str | None = None,
    folds: int = 5,
) -> DataFrame:
    """Entities with ``<relation>_avg_score`` and ``<relation>_count`` columns.

    ``relations`` maps a name to (bridge, person column). ``fill`` puts 0.5 for
    an entity without persons and turns a missing label into 0, keeping the
    original as ``label_og``; without it scores and labels stay null.
    ``leave_out`` keeps a train row's own label out of its scores: ``row`` or
    ``fold``, see ``leave_out_scores``.
    """
    if leave_out not in (None, "row", "fold"):
        raise ValueError(f"leave_out is row, fold or None, not {leave_out!r}")
    train = entities.where(F.col(subset) == "train")
    out = entities
    for name, (bridge, person) in relations.items():
        if leave_out:
            parts = folds if leave_out == "fold" else None
            scored = leave_out_scores(bridge, entities, person, key, label, subset, parts)
        else:
            scores = person_scores(bridge, train, person, key, label)
            scored = entity_scores(bridge, scores, person, key)
        per_entity = scored.select(
            key,
            F.col("avg_score").alias(f"{name}_avg_score"),
            F.col("person_count").alias(f"{name}_count"),
        )
        out = out.join(per_entity, key, "left").withColumn(
            f"{name}_count", F.coalesce(f"{name}_count", F.lit(0))
        )
    if not fill:
        return out
    for name in relations:
        score = f"{name}_avg_score"
        out = out.withColumn(score, F.coalesce(score, F.lit(UNSEEN)))
    return out.withColumn("label_og", F.col(label)).withColumn(
        label, _is_positive(F.col(label))
    )
