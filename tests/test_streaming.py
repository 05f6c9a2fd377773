from conftest import rows

from tabloom.sources import store
from tabloom.streaming import ingest

DDL = "k bigint, v string, at bigint"


def arrive(spark, folder, data):
    spark.createDataFrame(data, DDL).coalesce(1).write.mode("append").json(folder)


def test_each_file_is_read_once(spark, tmp_path):
    schema = spark.createDataFrame([], DDL).schema
    folder, sink, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    arrive(spark, folder, [(1, "a", 1)])
    for new in ([], [], [(2, "b", 2)]):
        if new:
            arrive(spark, folder, new)
        ingest.ingest(ingest.file_stream(spark, folder, schema), sink, state)
    assert rows(spark.read.schema(schema).parquet(sink)) == [(1, "a", 1), (2, "b", 2)]


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    schema = spark.createDataFrame([], DDL).schema
    folder, path = str(tmp_path / "in"), str(tmp_path / "table")
    arrive(spark, folder, [(1, "a", 1), (1, "late", 2), (2, "b", 1)])

    def run(state):
        ingest.upsert_stream(
            ingest.file_stream(spark, folder, schema),
            str(tmp_path / state),
            path,
            schema,
            ["k"],
            ["v"],
            ["at"],
            rows_per_bucket=1,
        )
        return rows(store.read_table(spark, path, schema))

    first = run("state")
    assert first == [(1, "a", 1), (2, "b", 1)]
    # A lost checkpoint delivers every file again.
    assert run("other-state") == first
    arrive(spark, folder, [(2, "c", 9), (3, "d", 9)])
    assert run("state") == [(1, "a", 1), (2, "c", 1), (3, "d", 9)]
