import random

import numpy as np
import pytest
from conftest import final_plan, rows

from tabloom.operators import cleaning, dedupe, ordered


def expected_running(data):
    """Rows (group, order, weight) with the weight of earlier group rows."""
    seen, out = {}, []
    for group, order, weight in sorted(data, key=lambda r: (repr(r[0]), r[1])):
        out.append((group, order, weight, seen.get(group, 0)))
        seen[group] = seen.get(group, 0) + weight
    return sorted(out, key=repr), seen


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_running_total_with_a_group_over_many_partitions(spark, partitions):
    random.seed(partitions)
    # "hot" holds most rows and spans partitions; None is a group too.
    groups = ["hot"] * 300 + [None] * 40 + [f"g{i % 50}" for i in range(160)]
    data = [(g, i, random.randint(0, 9)) for i, g in enumerate(groups)]
    df = spark.createDataFrame(data, "g string, o int, w long").repartition(7)
    out = ordered.running_total(
        df, ["o"], ["g"], weight="w", total="all", partitions=partitions
    )
    expected, totals = expected_running(data)
    assert rows(out, "g", "o", "w", "before") == expected
    assert {(r.g, r["all"]) for r in out.collect()} == set(totals.items())


def test_number_rows_is_dense_and_in_order(spark):
    df = spark.range(1000).selectExpr("id % 3 AS a", "id AS b").repartition(5)
    out = ordered.number_rows(df, ["a", "b"], partitions=6).collect()
    ranked = sorted(out, key=lambda r: r.row_num)
    assert [r.row_num for r in ranked] == list(range(1, 1001))
    assert [(r.a, r.b) for r in ranked] == sorted((r.a, r.b) for r in out)


def test_number_rows_of_nothing(spark):
    df = spark.createDataFrame([], "a int")
    assert ordered.number_rows(df, ["a"]).collect() == []


@pytest.mark.parametrize("size", [1, 2, 9, 500])
def test_quantiles_match_numpy(spark, size):
    random.seed(size)
    values = [random.choice([1.5, 2.0, random.random() * 100]) for _ in range(size)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    probs = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9, "e": 1.0}
    row = ordered.quantiles(df, "v", probs).first()
    for name, p in probs.items():
        assert row[name] == pytest.approx(np.quantile(values, p))


def test_weighted_quantile_repeats_the_row(spark):
    data = [(10, 1, "x"), (20, 5, "x"), (30, 2, "x"), (7, 3, None), (9, 3, None)]
    df = spark.createDataFrame(data, "v int, w long, g string")
    got = ordered.quantiles(df, "v", {"m": 0.5}, ["g"], "w").collect()
    assert {r.g: r.m for r in got} == {"x": 20.0, None: 8.0}


def test_quantiles_over_many_partitions(spark, conf):
    conf(adaptive__coalescePartitions__enabled="false", shuffle__partitions=13)
    random.seed(5)
    data = [("hot", float(i * 7919 % 1000)) for i in range(800)]
    data += [(f"g{i % 9}", random.random()) for i in range(90)]
    df = spark.createDataFrame(data, "g string, v double")
    probs = {"lo": 0.1, "mid": 0.5, "hi": 0.99}
    got = {r.g: r for r in ordered.quantiles(df, "v", probs, ["g"]).collect()}
    assert len(got) == 10
    for group, row in got.items():
        values = [v for g, v in data if g == group]
        for name, p in probs.items():
            assert row[name] == pytest.approx(np.quantile(values, p))
    both = ordered.column_quantiles(
        df.selectExpr("v", "v * 2 AS w"), ["v", "w"], {"mid": 0.5}
    )
    mid = np.median([v for _, v in data])
    assert dict(rows(both)) == {"v": pytest.approx(mid), "w": pytest.approx(2 * mid)}


def test_quantiles_of_nulls(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert ordered.quantiles(df, "v", {"m": 0.5}).first().m is None


def test_no_window_runs_in_one_task(spark):
    df = spark.range(2000).selectExpr("id", "id % 2 AS g")
    plan = final_plan(dedupe.duplicate_rows(df, ["g"], ["id"], large=100))
    # The big window is clustered by stored partition and group.
    assert "hashpartitioning(__part" in plan
    assert "Window" in plan
    assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan


def test_duplicate_rows_number_a_hot_group(spark):
    df = spark.range(900).selectExpr("id", "if(id < 600, 0, id) AS g")
    out = dedupe.duplicate_rows(df, ["g"], ["id"]).collect()
    assert sorted((r.id, r.row_num) for r in out) == [(i, i + 1) for i in range(1, 600)]


def test_sketches_stay_within_their_error_and_can_be_merged(spark):
    rng = np.random.default_rng(3)
    data = [
        (int(i % 3), float(x), int(w))
        for i, (x, w) in enumerate(
            zip(np.exp(rng.normal(0, 6, 3000)) * rng.choice([-1, 0, 1], 3000), rng.integers(0, 5, 3000))
        )
    ]
    df = spark.createDataFrame([*data, (0, None, 1)], "g int, v double, w long")
    wanted = {"p1": 0.01, "p50": 0.5, "p99": 0.99}
    error = 0.02
    parts = [
        ordered.quantile_sketch(df.where(f"pmod(hash(v), 2) = {i}"), ["v"], error, ["g"], "w")
        for i in (0, 1)
    ]
    merged = parts[0].unionByName(parts[1])
    got = {r.g: r for r in ordered.sketch_quantiles(merged, wanted, ["g"]).collect()}
    exact = {r.g: r for r in ordered.quantiles(df, "v", wanted, ["g"], "w").collect()}
    for g, row in exact.items():
        for name in wanted:
            assert abs(got[g][name] - row[name]) <= error * abs(row[name]) + 1e-12
    wide = ordered.quantile_sketch(spark.range(100_000).selectExpr("id * id AS v"), ["v"], error)
    assert wide.count() < 700


def test_approximate_medians_take_weights(spark):
    df = spark.createDataFrame([(1.0, 1), (10.0, 5), (500.0, 1)], "v double, w long")
    got = cleaning.medians(df, ["v"], weight="w", method="approx").first().v
    assert got == pytest.approx(10, rel=0.01)
