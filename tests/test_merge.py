import datetime

from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tabloom.operators import constraints, dedupe, merge

SCHEMA = "k int, a string, b string"
STAGED = "k int, a string, b string, o int"


def frame(spark, data, schema=SCHEMA):
    return spark.createDataFrame(data, schema)


def upsert(target, staged, **more):
    return merge.upsert(target, staged, ["k"], ["a"], ["o"], **more)


def test_upsert_overwrites_listed_columns_only(spark):
    target = frame(spark, [(1, "x", "old"), (2, "y", "old")])
    staged = frame(spark, [(1, "new", "z", 0), (3, "c", "z", 0)], STAGED)
    expected = [(1, "new", "old"), (2, "y", "old"), (3, "c", "z")]
    assert rows(upsert(target, staged)) == expected


def test_staged_null_overwrites(spark):
    target = frame(spark, [(1, "x", "old")])
    staged = frame(spark, [(1, None, None, 0)], STAGED)
    assert rows(upsert(target, staged)) == [(1, None, "old")]


def test_conflicts_inside_a_batch(spark):
    staged = frame(spark, [(1, "second", "s", 2), (1, "first", "f", 1)], STAGED)
    target = frame(spark, [])
    assert rows(upsert(target, staged)) == [(1, "first", "f")]
    assert rows(upsert(target, staged, keep="last")) == [(1, "second", "s")]


keyed = st.dictionaries(st.integers(0, 6), st.sampled_from(["p", "q", None]), max_size=5)


@settings(max_examples=8, deadline=None)
@given(old=keyed, new=keyed)
def test_upsert_is_idempotent_and_complete(spark, old, new):
    target = frame(spark, [(k, v, "old") for k, v in old.items()])
    staged = frame(spark, [(k, v, "new", k) for k, v in new.items()], STAGED)
    once = upsert(target, staged)
    expected = {k: (v, "old") for k, v in old.items()}
    for k, v in new.items():
        expected[k] = (v, expected[k][1] if k in old else "new")
    assert rows(once) == sorted(((k, *v) for k, v in expected.items()), key=repr)
    assert rows(upsert(once, staged)) == rows(once)


def test_insert_ignore_never_changes_a_row(spark):
    target = frame(spark, [(1, "x", "old")])
    staged = frame(spark, [(1, "n", "n", 0), (2, "n", "n", 1), (2, "m", "m", 0)], STAGED)
    out = merge.insert_ignore(target, staged, ["k"], ["o"])
    assert rows(out) == [(1, "x", "old"), (2, "m", "m")]


def test_append_fills_the_audit_time(spark):
    target = spark.createDataFrame([], "k int, audit_time timestamp")
    out = merge.append(target, spark.createDataFrame([(1,)], "k int")).first()
    assert isinstance(out.audit_time, datetime.datetime)


def test_constraint_checks(spark):
    parent = spark.createDataFrame([(1,), (2,)], "k int")
    child = frame(spark, [(1, "x", "u"), (3, "y", None), (3, "z", "v"), (None, "w", "v")])
    assert rows(constraints.fk_accepted(child, parent, "k"), "a") == [("x",)]
    assert rows(constraints.fk_orphans(child, parent, "k"), "a") == [("w",), ("y",), ("z",)]
    assert rows(constraints.pk_violations(child, ["k"])) == [(3, 2), (None, 1)]
    assert rows(constraints.null_violations(child, ["k", "b"]), "a") == [("w",), ("y",)]


def test_duplicate_groups_count_nulls_together(spark):
    df = frame(spark, [(1, None, "x"), (1, None, "x"), (2, "y", "x")])
    assert dedupe.duplicate_group_count(df, ["k", "a", "b"]).first()[0] == 1
    assert rows(dedupe.keep_one(df, ["k"], ["a", "b"])) == [(1, None, "x"), (2, "y", "x")]


def test_duplicate_rows_of_large_and_small_groups(spark):
    df = spark.range(3000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN NULL WHEN id % 3 = 1 THEN id % 50 ELSE 1000 + id END AS c",
        "id * 7919 % 3000 AS o", "id AS payload",
    )
    content, order = ["c"], ["o"]
    window = Window.partitionBy("c").orderBy("o")
    expected = rows(
        df.withColumn("row_num", F.row_number().over(window).cast("long")).where("row_num > 1")
    )
    for large in (1, 30, 500, 10_000):
        got = dedupe.duplicate_rows(df, content, order, large=large)
        assert got.columns == [*df.columns, "row_num"]
        assert rows(got) == expected
