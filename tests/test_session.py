from types import SimpleNamespace

import pytest
from conftest import rows

from tabloom import session


def fake(master, folder=None):
    """A session with just the settings the lookup reads."""
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda name, default=None: folder or default),
        sparkContext=SimpleNamespace(master=master, applicationId=f"app-{master}"),
    )


def test_the_cluster_names_the_folder():
    assert session.shared_dir(fake("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    path = session.scratch_path(fake("yarn", "hdfs:///shared"), "part")
    assert path.startswith("hdfs:///shared/tabloom/app-yarn/part-")


def test_a_cluster_without_the_setting_is_an_error():
    with pytest.raises(RuntimeError):
        session.shared_dir(fake("yarn"))


def test_local_mode_has_one_folder_per_application():
    one = session.shared_dir(fake("local[2]"))
    assert one == session.shared_dir(fake("local[2]"))
    assert one != session.shared_dir(fake("local[4]"))


def test_stored_tables_keep_rows_and_schema(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    stored = session.materialize(df, "test")
    assert stored.schema == df.schema and rows(stored) == rows(df)
    empty = session.materialize(df.where("a > 5"), "test")
    assert empty.count() == 0 and empty.schema == df.schema


def test_a_missing_table_reads_as_none(spark, tmp_path):
    assert session.read_if_exists(spark, str(tmp_path / "nothing")) is None
    (tmp_path / "hollow").mkdir()
    assert session.read_if_exists(spark, str(tmp_path / "hollow")) is None
