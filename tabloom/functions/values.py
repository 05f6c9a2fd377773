"""Numbers, years, null tokens and file names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The words a pandas CSV reader takes for null.
PANDAS_NULLS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)
MISSING = "\\N"


def null_if_in(text: Column, tokens: Sequence[str]) -> Column:
    """Null for every token, the text otherwise."""
    return F.when(~text.isin(*tokens), text) if tokens else text


def to_number(text: Column) -> Column:
    """Text as a double; null where it is not a number."""
    return text.try_cast("double")


def truncate_int(number: Column) -> Column:
    """Towards zero, like an int cast in pandas."""
    return number.cast("int")


def release_year(start: Column, end: Column, prefer: str = "start") -> Column:
    """The preferred year, or the other one where it is missing."""
    return F.coalesce(start, end) if prefer == "start" else F.coalesce(end, start)


def votes_per_year(votes: Column, year: Column, ref_year: int = 2024) -> Column:
    """Votes per year since release; null (not infinity) in ``ref_year``."""
    return F.try_divide(votes, F.lit(ref_year) - year)


def is_staged_file(name: Column) -> Column:
    """Names that contain .csv or .json anywhere."""
    return name.contains(".csv") | name.contains(".json")


def file_route(name: Column, loose: bool = False) -> Column:
    """Where a staged file goes: val, test, train, a relation's stem, or null.

    A relation is named by the first folder or file of the name that carries
    .json, up to its first dot. The loose routing takes any 'validation' or
    'test' in the name and calls every other CSV file train.
    """
    val, test = ("validation", "test") if loose else (
        "validation_hidden.csv",
        "test_hidden.csv",
    )
    is_csv = name.contains(".csv")
    train = is_csv if loose else is_csv & name.contains("train")
    return (
        F.when(
            name.contains(".json"),
            F.regexp_extract(name, r"([^/.]*)[^/]*\.json", 1),
        )
        .when(is_csv & name.contains(val), "val")
        .when(is_csv & name.contains(test), "test")
        .when(train, "train")
    )
