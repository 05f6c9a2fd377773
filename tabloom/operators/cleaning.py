"""Null handling, imputation and subset bookkeeping."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom import schemas
from tabloom.functions.text import normalise_title
from tabloom.functions.values import MISSING, release_year, truncate_int
from tabloom.operators.ordered import column_quantiles


def sentinel_to_null(df: DataFrame, sentinel: str = MISSING) -> DataFrame:
    """The sentinel text becomes null in every string column."""
    return df.select(
        *[
            F.nullif(F.col(n), F.lit(sentinel)).alias(n) if t == "string" else F.col(n)
            for n, t in df.dtypes
        ]
    )


def clean_bridge(
    df: DataFrame, renames: Mapping[str, str], distinct: bool = True
) -> DataFrame:
    """A two-column relation: sentinels out, incomplete rows out, distinct."""
    named = df.select(*[F.col(old).alias(new) for old, new in renames.items()])
    whole = sentinel_to_null(named).dropna("any")
    return whole.distinct() if distinct else whole


def medians(
    df: DataFrame,
    columns: Sequence[str],
    weight: str | None = None,
    method: str = "exact",
) -> DataFrame:
    """One row with the median of each column.

    ``exact`` ranks the distinct values of all columns in one distributed pass
    and holds for any number of them. ``builtin`` keeps every distinct value in
    one buffer: only for columns known to be narrow (minutes, years). ``approx``
    is a sketch: each median within one per cent of its value.
    """
    if method == "builtin":
        freq = F.col(weight) if weight else F.lit(1)
        return df.agg(*[F.percentile(c, 0.5, freq).alias(c) for c in columns])
    error = 0.01 if method == "approx" else None
    per_field = column_quantiles(df, columns, {"median": 0.5}, weight=weight, error=error)
    return per_field.agg(
        *[F.max(F.when(F.col("field") == c, F.col("median"))).alias(c) for c in columns]
    )


def impute(df: DataFrame, fills: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls of each column take the value of the one-row table ``fills``.

    The row is fetched once, as a fitted imputer keeps its medians.
    """
    row = fills.select(*columns).first()
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(row[c])) for c in columns})


def impute_median(
    df: DataFrame,
    columns: Sequence[str],
    fit_on: DataFrame | None = None,
    method: str = "exact",
) -> DataFrame:
    """Fill nulls with the median of ``fit_on`` (by default of ``df``)."""
    fills = medians(df if fit_on is None else fit_on, columns, method=method)
    return impute(df, fills, columns)


def title_features(
    df: DataFrame,
    primary: str = "primary_title",
    original: str = "original_title",
    *,
    delete_marks: bool = False,
    null_text: str | None = "nan",
    fill_original: bool = True,
) -> DataFrame:
    """Normalised titles, whether they differ, and the length of the first."""
    other = F.coalesce(original, primary) if fill_original else F.col(original)
    style = {"delete_marks": delete_marks, "null_text": null_text}
    # Unpacked by a generator, so that the flag and the length reuse the clean
    # titles; stacked projections would be merged and clean them again.
    titles = F.struct(
        normalise_title(F.col(primary), **style).alias(primary),
        normalise_title(other, **style).alias(original),
    )
    return (
        df.select(
            *[c for c in df.columns if c not in (primary, original)],
            F.inline(F.array(titles)),
        )
        .withColumn("title_changed", ~F.col(primary).eqNullSafe(F.col(original)))
        .withColumn("title_length", F.length(primary))
    )


def tag_subsets(parts: Mapping[str, DataFrame], label: str = "label") -> DataFrame:
    """Stack frames by column name with their subset name; absent labels null."""
    tagged = [
        (part if name == "train" else part.drop(label)).withColumn(
            "subset", F.lit(name)
        )
        for name, part in parts.items()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def split_by_subset(
    df: DataFrame, label: str = "label"
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Complete train rows, and the test and validation rows without label."""

    def rows(name: str) -> DataFrame:
        return df.where(F.col("subset") == name).drop("subset")

    return rows("train").dropna(), rows("test").drop(label), rows("val").drop(label)


def clean_movies(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Staged film rows in table form, and the rows rejected for lack of an id or year.

    ``raw`` holds the stacked raw columns and ``subset``; numbers are text. Other
    columns stay as they are.
    """
    taken = {*schemas.RAW_TRAIN, "subset"}
    typed = raw.select(
        F.col("tconst").alias("movie_id"),
        F.col("primaryTitle").alias("primary_title"),
        F.col("originalTitle").alias("original_title"),
        release_year(
            F.col("startYear").try_cast("double"), F.col("endYear").try_cast("double")
        ).alias("start_year"),
        F.col("runtimeMinutes").try_cast("double").alias("runtime_min"),
        F.col("numVotes").try_cast("double").alias("num_votes"),
        F.col("label").try_cast("boolean").alias("label"),
        "subset",
        *[c for c in raw.columns if c not in taken],
    )
    complete = F.col("start_year").isNotNull() & F.col("movie_id").isNotNull()
    filled = impute_median(typed, ["runtime_min", "num_votes"])
    whole = filled.where(complete).withColumns(
        {
            c: truncate_int(F.col(c))
            for c in ("start_year", "runtime_min", "num_votes")
        }
    )
    return title_features(whole), typed.where(~complete)
