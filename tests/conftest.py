import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tabloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8)
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    before = {}

    def put(**options):
        for name, value in options.items():
            key = "spark.sql." + name.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, str(value))

    yield put
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def final_plan(df) -> str:
    """The physical plan after the query ran."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()
