import datetime

import pytest
from conftest import final_plan, rows

from tabloom import schemas
from tabloom.operators import dedupe, profile, quality

NOW = datetime.datetime(2024, 1, 1)
# Six films, three of them repeated under another id.
FILMS = [
    (f"tt00123{45 + i}", title, title, year, minutes, votes, label, subset, changed, 7, NOW)
    for i, (title, year, minutes, votes, label, subset, changed) in enumerate(
        2
        * [
            ("Movie A", 2020, 120, 1000, True, "subset1", False),
            ("Movie B", 2021, 110, 1500, False, "subset2", True),
            ("Movie C", 2019, 105, 800, True, "subset3", False),
        ]
    )
]


@pytest.fixture(scope="module")
def films(spark):
    return spark.createDataFrame(FILMS, schemas.MOVIES)


def test_duplicates(films):
    found = dedupe.duplicate_rows(
        films, schemas.MOVIE_CONTENT_COLS, ["audit_time", "movie_id"]
    )
    assert rows(found, "movie_id", "row_num") == [
        ("tt0012348", 2),
        ("tt0012349", 2),
        ("tt0012350", 2),
    ]
    count = dedupe.duplicate_group_count(films, schemas.MOVIE_DUPLICATE_COLS)
    assert count.first().duplicate_count == 3


def test_report(spark, films):
    directing = spark.createDataFrame(
        [("nm1234567", "tt0012345", NOW), ("nm12\n", "tt0012345", NOW), (None, "x", None)],
        schemas.DIRECTING,
    )
    writing = spark.createDataFrame([], schemas.WRITING)
    got = {
        (r.Field, r.correct_or_error_type): (r.Count, r.duplicate_count, r.correct_or_error)
        for r in quality.film_report(films, directing, writing).collect()
    }
    assert got[("movies.subset", "string_format_Error")] == (6, 3, "Error")
    others = {k: v for k, v in got.items() if k[0].startswith("movies.")}
    assert len(others) == len(schemas.MOVIES)
    assert all(
        v == (6, 3, "Correct") for k, v in others.items() if k[0] != "movies.subset"
    )
    assert got[("directing.director_id", "null_Error")] == (1, 0, "Error")
    assert got[("directing.director_id", "string_format_Error")] == (1, 0, "Error")
    assert got[("directing.movie_id", "Correct")] == (2, 0, "Correct")
    assert got[("directing.audit_time", "Error")] == (1, 0, "Error")
    assert not any(k[0].startswith("writing.") for k in got)


def test_id_with_a_trailing_newline_is_an_error(spark):
    df = spark.createDataFrame([("tt1234567\n",)], "movie_id string")
    out = quality.profile(df, "t", quality.MOVIE_RULES[:1])
    assert rows(out, "correct_or_error_type") == [("string_format_Error",)]


def test_one_scan_and_one_exchange_per_table(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    rules = [quality.Rule("o_orderkey"), quality.Rule("o_custkey"), quality.Rule("o_orderstatus")]
    plan = final_plan(quality.profile(orders, "orders", rules)).split("Initial Plan")[0]
    assert plan.count("FileScan") == 1
    assert plan.count("Exchange ") <= 1


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0, 5), (10.0, 5), (4.9, None)], "a double, b int")
    got = rows(profile.histogram(df, ["a", "b"], 2), "field", "bin", "n")
    assert got == [("a", 0, 2), ("a", 1, 1), ("b", 0, 2)]


def test_value_counts_order(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "x string")
    assert [tuple(r) for r in profile.value_counts(df, "x").collect()] == [
        ("c", 2),
        ("a", 1),
        ("b", 1),
    ]


def test_correlation_leaves_out_null_pairs(spark):
    df = spark.createDataFrame(
        [(1, 2.0, True), (2, 4.0, False), (3, None, True), (4, 8.0, False)],
        "a int, b double, y boolean",
    )
    got = {(r.a, r.b): r.r for r in profile.correlation(df, ["a", "b", "y"]).collect()}
    assert got[("a", "b")] == pytest.approx(1.0)
    assert got[("y", "a")] == got[("a", "y")] < 0
