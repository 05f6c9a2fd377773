"""Rule-based data-quality report: one scan per table.

A rule set is data: per field the status of a null, then (broken-if, status)
pairs in order. Statuses are a closed set, so every (field, status) count is
one conditional sum of the same aggregate; nothing is unioned per field and no
row is multiplied.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom import schemas
from tabloom.operators.dedupe import duplicate_group_count

CORRECT = "Correct"


@dataclass(frozen=True)
class Rule:
    """Checks of one field; ``broken`` maps the frame's columns to conditions."""

    name: str
    null_status: str = "null_Error"
    broken: Sequence[tuple[Callable[[], Column], str]] = field(default_factory=tuple)

    def statuses(self) -> list[str]:
        return list(dict.fromkeys([self.null_status, *[s for _, s in self.broken], CORRECT]))

    def status(self) -> Column:
        chain = F.when(F.col(self.name).isNull(), self.null_status)
        for condition, status in self.broken:
            chain = chain.when(condition(), status)
        return chain.otherwise(CORRECT)


def profile(df: DataFrame, table: str, rules: Sequence[Rule]) -> DataFrame:
    """Rows per (field, status); statuses without rows do not appear."""
    # Each status is worked out once per row, then counted per outcome.
    judged = df.select(*[rule.status().alias(rule.name) for rule in rules])
    counted = judged.agg(
        *[
            F.count_if(F.col(rule.name) == status).alias(f"{rule.name}|{status}")
            for rule in rules
            for status in rule.statuses()
        ]
    )
    cells = [
        F.struct(
            F.lit(f"{table}.{rule.name}").alias("Field"),
            F.lit(table).alias("table_name"),
            F.lit(status).alias("correct_or_error_type"),
            F.col(f"`{rule.name}|{status}`").alias("Count"),
        )
        for rule in rules
        for status in rule.statuses()
    ]
    return counted.select(F.inline(F.array(*cells))).where("Count > 0")


def report(
    tables: Mapping[str, tuple[DataFrame, Sequence[Rule], Sequence[str]]],
) -> DataFrame:
    """The profiles of all tables with error flag and duplicate-group count.

    ``tables`` maps a name to (frame, rules, columns that define a duplicate).
    """
    parts = [
        profile(df, name, rules).withColumn(
            "duplicate_count", duplicate_group_count(df, keys).scalar()
        )
        for name, (df, rules, keys) in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts).withColumn(
        "correct_or_error",
        F.when(F.col("correct_or_error_type").contains("Error"), "Error").otherwise(
            CORRECT
        ),
    )


def side_by_side(reports: Mapping[str, DataFrame], base: str) -> DataFrame:
    """Reports of several stores in one table, each count beside that of ``base``.

    Per store, field and status: ``Count``, ``duplicate_count`` and
    ``correct_or_error`` of the store, ``base_count``, and ``share`` and
    ``base_share`` of the field's rows. A status that a store has no row of is a
    row with count 0 if another one has it.
    """
    names = ["Field", "table_name", "correct_or_error_type", "correct_or_error"]
    rows = reduce(
        DataFrame.unionByName,
        [report.withColumn("store", F.lit(name)) for name, report in reports.items()],
    )
    stores = F.array(*map(F.lit, reports))
    # Reports have a row per rule and status, whatever the tables hold.
    wide = (
        rows.groupBy(*names)
        .agg(F.map_from_entries(F.collect_list(F.struct("store", "Count"))).alias("counts"))
        .select(*names, "counts", F.explode(stores).alias("store"))
        .withColumn("Count", F.coalesce(F.col("counts")[F.col("store")], F.lit(0)))
        .withColumn("base_count", F.coalesce(F.col("counts")[base], F.lit(0)))
    )
    repeated = rows.groupBy("store", "table_name").agg(
        F.max("duplicate_count").alias("duplicate_count")
    )
    totals = wide.groupBy("store", "Field").agg(
        F.sum("Count").alias("rows"), F.sum("base_count").alias("base_rows")
    )
    return (
        wide.join(totals, ["store", "Field"])
        .join(repeated, ["store", "table_name"], "left")
        .select(
            "store",
            *names,
            "Count",
            F.coalesce("duplicate_count", F.lit(0)).alias("duplicate_count"),
            F.try_divide("Count", "rows").alias("share"),
            "base_count",
            F.try_divide("base_count", "base_rows").alias("base_share"),
        )
    )


# --- film catalogue preset -------------------------------------------------
# Id formats, null words, limits and statuses of the report. The
# title rule of primary_title tests original_title for the null words.
PERSON_ID = r"^nm[0-9]{6,10}\z"
FILM_ID = r"^tt[0-9]{6,10}\z"
NULL_WORDS = ("nan", "null", "Nan", "NaN")
SUBSETS = ("val", "train", "test")
FORMAT_ERROR, VALUE_ERROR = "string_format_Error", "value_Error"
MIN_TITLE, MAX_TITLE = 3, 100
FIRST_YEAR, MIN_RUNTIME, MIN_VOTES = 1888, 40, 0


def _pattern(name: str, pattern: str) -> Rule:
    return Rule(name, broken=((lambda: ~F.col(name).rlike(pattern), FORMAT_ERROR),))


def _at_least(name: str, limit: int) -> Rule:
    return Rule(name, broken=((lambda: F.col(name) < limit, VALUE_ERROR),))


def _title(name: str) -> Rule:
    def broken() -> Column:
        size = F.length(name)
        return (
            (size < MIN_TITLE)
            | (size > MAX_TITLE)
            | F.col("original_title").isin(*NULL_WORDS)
        )

    return Rule(name, broken=((broken, FORMAT_ERROR),))


def _one_of(name: str, allowed: Sequence[str]) -> Rule:
    return Rule(
        name,
        broken=((lambda: ~F.col(name).cast("string").isin(*allowed), FORMAT_ERROR),),
    )


def _bridge_rules(person: str) -> list[Rule]:
    return [
        _pattern(person, PERSON_ID),
        _pattern("movie_id", FILM_ID),
        Rule("audit_time", null_status="Error"),
    ]


WRITING_RULES = _bridge_rules("writer_id")
DIRECTING_RULES = _bridge_rules("director_id")
MOVIE_RULES = [
    _pattern("movie_id", FILM_ID),
    _title("primary_title"),
    _title("original_title"),
    _at_least("start_year", FIRST_YEAR),
    _at_least("runtime_min", MIN_RUNTIME),
    _at_least("num_votes", MIN_VOTES),
    # Booleans always read true or false, so these two find nulls only.
    _one_of("label", ("false", "true")),
    _one_of("subset", SUBSETS),
    _one_of("title_changed", ("true", "false")),
    Rule(
        "title_length",
        broken=(
            (
                lambda: ~F.col("title_length").between(MIN_TITLE, MAX_TITLE),
                VALUE_ERROR,
            ),
        ),
    ),
    Rule("audit_time", null_status="Error"),
]


def film_report(
    movies: DataFrame, directing: DataFrame, writing: DataFrame
) -> DataFrame:
    """The report over the three film tables."""
    return report(
        {
            "writing": (writing, WRITING_RULES, ["writer_id", "movie_id"]),
            "directing": (directing, DIRECTING_RULES, ["director_id", "movie_id"]),
            "movies": (movies, MOVIE_RULES, schemas.MOVIE_DUPLICATE_COLS),
        }
    )


def film_reports(
    stores: Mapping[str, tuple[DataFrame, DataFrame, DataFrame]], base: str
) -> DataFrame:
    """``film_report`` of several stores (movies, directing, writing) side by side."""
    reports = {name: film_report(*tables) for name, tables in stores.items()}
    return side_by_side(reports, base)
