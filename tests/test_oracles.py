"""Every query against its SQL twin on the smallest test tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_point

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()
QUERIES, ORACLES = entry_point.queries(), entry_point.oracle_sql()
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    yield con
    con.close()


def text(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, db, name):
    df = QUERIES[name](spark, FOLDER)
    answer = db.execute(ORACLES[name])
    types = {d[0]: str(d[1]) for d in answer.description}
    columns = sorted(df.columns)
    assert columns == sorted(types)
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    order = [list(types).index(c) for c in columns]
    expected = sorted(tuple(text(r[i]) for i in order) for r in answer.fetchall())
    actual = sorted(tuple(text(r[c]) for c in columns) for r in df.collect())
    assert actual == expected


@pytest.mark.parametrize("name", ["score_gbt", "score_dt", "kfold_accuracy", "holdout_accuracy"])
def test_model_queries_run(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry(spark):
    assert entry_point.entry(spark).count() == 1500
