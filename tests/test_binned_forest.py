"""Forests over rows in bins, held against Spark's own."""

import uuid

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabloom.operators import binned_forest, forest_search, missing, ml
from tabloom.operators.split import fold_column
from tabloom.plans import scoring


def prepared(spark, n=4000):
    rows = spark.range(n).selectExpr(
        "id AS movie_id",
        "double(id * 7919 % 1009) AS a",
        "double(id * 31 % 7) AS b",
        "double(id * id % 211) / 3 AS c",
        "int(pmod(hash(id), 100)) AS noise",
    )
    label = F.expr("int(a / 500 + b / 5 + c / 60 + noise / 100 > 2.6)")
    return ml.assemble(rows.withColumn("label", label), ["a", "b", "c"]).drop("noise")


def jobs_of(spark, work) -> int:
    group = f"jobs-{uuid.uuid4()}"
    spark.sparkContext.setJobGroup(group, "")
    try:
        work()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_a_deeper_forest_takes_no_more_passes_over_the_rows(spark):
    rows = prepared(spark)
    shallow, deep = (
        jobs_of(spark, lambda: ml.random_forest(30, depth, 20).fit(rows)) for depth in (2, 12)
    )
    assert deep == shallow


class EveryRowOnce:
    """Draws that take every row as often as it is there."""

    def poisson(self, lam, size=None):
        return np.ones(size, int) if size else np.array(lam)


@pytest.mark.parametrize("bins, depth", [(2, 3), (9, 1), (20, 4), (64, 7)])
def test_a_tree_of_every_row_is_the_one_that_spark_grows(spark, bins, depth):
    rows = prepared(spark)
    rows = rows.unionByName(rows.where("movie_id % 3 = 0"))  # counts of more than one
    found = binned_forest.Rows.of(
        rows.select(
            vector_to_array("features").alias("x"),
            F.col("label").cast("double").alias("label"),
            F.lit(0).alias("fold"),
        )
    )
    cuts = found.cuts(bins)
    table = binned_forest.entries(found.df, cuts).toArrow().sort_by("label")
    zeros = int((table.column("label").to_numpy() == 0).sum())
    x = np.ascontiguousarray(binned_forest.bins_of(table, 3).T)
    feature, cut, left, *counts = binned_forest.grow_tree(
        x, table.column("n").to_numpy(), zeros, max(map(len, cuts)) + 1, depth, 3, EveryRowOnce()
    )
    threshold = [cuts[f][c] if f >= 0 else 0.0 for f, c in zip(feature, cut)]
    lists = {"feature": feature, "threshold": threshold, "left": left,
             "zeros": counts[0], "ones": counts[1]}
    nodes = forest_search.NodeTable.grown(
        pa.table({"tree": [0]} | {k: pa.array([list(v)]) for k, v in lists.items()})
    )
    tree = DecisionTreeClassifier(maxBins=bins, maxDepth=depth, seed=1).fit(rows)
    told = tree.transform(rows).select(
        vector_to_array("features").alias("x"), vector_to_array("probability")[1].alias("p")
    ).collect()
    got = forest_search.scores(np.array([r.x for r in told]), nodes, [1], [depth])[:, 0, 0]
    assert got == pytest.approx([r.p for r in told], abs=1e-12)
    assert len(nodes.feature) == tree.numNodes


def test_forests_are_as_good_as_sparks_and_scored_alike(spark, tmp_path):
    train, test = prepared(spark, 6000).randomSplit([0.7, 0.3], 1)
    forest = ml.random_forest(40, 8, 20)
    model, sparks = forest.fit(train), forest.grown_in_parts(train)

    def right(m):
        return ml.accuracy(m.transform(test), "label").first().accuracy

    assert model.getNumTrees == 40 and model.numFeatures == 3
    assert right(model) == pytest.approx(right(sparks), abs=0.02)
    assert model.featureImportances.toArray() == pytest.approx(
        sparks.featureImportances.toArray(), abs=0.08
    )
    model.write().save(str(tmp_path / "forest"))
    again = RandomForestClassificationModel.load(str(tmp_path / "forest"))
    vectors = [vector_to_array("rawPrediction").alias("r"), vector_to_array("probability").alias("p")]
    a, b = (
        m.transform(test).orderBy("movie_id").select("prediction", *vectors).collect()
        for m in (model, again)
    )
    assert [r.prediction for r in a] == [r.prediction for r in b]
    assert np.allclose([r.r for r in a], [r.r for r in b])
    assert np.allclose([r.p for r in a], [r.p for r in b])


def test_a_forest_does_not_depend_on_how_rows_are_laid_out(spark):
    rows = prepared(spark, 1000)
    forest = ml.random_forest(5, 6, 16)
    a, b = (forest.fit(r).toDebugString.split("\n", 1)[1] for r in (rows.coalesce(1), rows.repartition(7)))
    assert a == b


def test_rows_that_spark_refuses_are_refused(spark):
    rows = prepared(spark, 50)
    for label in ("CASE WHEN movie_id > 3 THEN label END", "label - 1"):
        with pytest.raises(Exception, match="(?i)label"):
            ml.random_forest(3, 2, 8).fit(rows.withColumn("label", F.expr(label)))
    three = rows.withColumn("label", F.expr("movie_id % 3"))  # more classes are Spark's
    assert ml.random_forest(3, 2, 8).fit(three).numClasses == 3


def test_many_values_are_summed_up_by_their_ranks():
    values = np.random.default_rng(1).permutation(100_000).astype(float)
    found, counts = binned_forest._summary(values)
    assert len(found) <= 2_048 and counts.sum() == 100_000
    cuts = binned_forest.thresholds(found, counts, 20)
    assert len(cuts) == 19 and np.abs(np.diff(cuts) - 5_000).max() < 200
    hot = np.append(values, np.zeros(100_000))
    found, counts = binned_forest._summary(hot)
    assert abs(counts[0] - 100_001) < 200 and counts.sum() == 200_000
    few = np.repeat([3.0, 1.0, 2.0], 5)
    assert [list(x) for x in binned_forest._summary(few)] == [[1, 2, 3], [5, 5, 5]]
    assert list(binned_forest.thresholds(*binned_forest._summary(few), 32)) == [1.5, 2.5]


@pytest.mark.parametrize("metric", ["accuracy", "auc"])
def test_a_search_takes_no_more_passes_for_deeper_trees(spark, metric):
    rows = prepared(spark, 1500)

    def searched(depth):
        found = forest_search.search(
            rows, ["movie_id"], (4, 8), (1, depth), (8,), metric, folds=2, parallelism=1
        )
        assert found.count() == 8

    shallow, deep = (jobs_of(spark, lambda: searched(depth)) for depth in (2, 12))
    assert deep == shallow


def test_rows_of_the_same_bins_are_graded_as_each_of_them(spark):
    rows = fold_column(prepared(spark, 3000), ["movie_id"], 3).select(
        vector_to_array("features").alias("x"), F.col("label").cast("double").alias("label"), "fold"
    )
    graded = forest_search.search(
        prepared(spark, 3000), ["movie_id"], (3, 9), (2, 5), (6,), "accuracy", folds=3
    )
    found = {(r.num_trees, r.max_depth, r.fold): r for r in graded.collect()}
    assert len(found) == 12
    cuts = binned_forest.Rows.of(rows).cuts(6, 1)
    train = binned_forest.entries(rows, cuts, 1).where("NOT tested").toArrow()
    assert train.num_rows < 500  # far fewer than rows
    nodes = forest_search.NodeTable.grown(
        binned_forest.grow(spark, train, cuts, 9, 5, ml.SEED).toArrow()
    )
    tested = rows.where("fold = 1").toArrow().to_pydict()
    share = forest_search.scores(np.array(tested["x"]), nodes, [3, 9], [2, 5])
    for i, trees in enumerate((3, 9)):
        for j, depth in enumerate((2, 5)):
            hits = (share[:, i, j] > 0.5) == (np.array(tested["label"]) > 0.5)
            row = found[trees, depth, 1]
            assert row.n_test == len(hits) and row.metric == pytest.approx(hits.mean())


def test_an_area_of_counted_rows_is_that_of_all_of_them(spark):
    rows = spark.range(200).selectExpr(
        "double(id * 37 % 11) AS score", "int(id * 53 % 7 > 3) AS label", "id % 4 AS n"
    )
    each = rows.selectExpr("*", "explode(sequence(1, 3)) AS i").where("i <= n")
    counted = ml.auc(rows.where("n > 0"), "label", "score", weight="n").first().auc
    assert counted == pytest.approx(ml.auc(each, "label", "score").first().auc)


def test_a_search_falls_back_on_sparks_forest(spark, monkeypatch):
    monkeypatch.setattr(ml, "FIT_BYTES", 1)
    graded = forest_search.search(
        prepared(spark, 400), ["movie_id"], (2, 5), (2,), (8,), "accuracy", folds=2
    )
    assert sorted(r.n_test for r in graded.collect()) == sorted(
        2 * [r["count"] for r in fold_column(prepared(spark, 400), ["movie_id"], 2)
             .groupBy("fold").count().collect()]
    )


def test_the_raw_baseline_takes_no_more_passes_for_deeper_trees(spark, tmp_path):
    raw = spark.range(800).selectExpr(
        "string(id) AS tconst",
        "CASE WHEN id % 5 > 0 THEN double(id * 31 % 100) END AS minutes",
        "double(id * 7919 % 53) AS votes",
        "int(id % 5 > 0 AND id * 31 % 100 + id * 7919 % 53 > 70) AS label",
    )
    hidden = raw.selectExpr("int(tconst) AS place", "minutes", "votes").limit(50)

    def scored(depth):
        model, _ = scoring.raw_baseline(
            raw, ["minutes", "votes"], ["tconst"], folds=2, trees=(4,), depths=(depth,)
        )
        scoring.score_hidden(model, {"val": hidden}, ["place"], f"{tmp_path}/{depth}")
        assert len(spark.read.csv(f"{tmp_path}/{depth}/val").collect()) == 50

    shallow, deep = (jobs_of(spark, lambda: scored(depth)) for depth in (2, 10))
    assert deep == shallow


def test_many_columns_make_keys_of_several_words(spark):
    names = [f"v{i}" for i in range(11)]
    rows = spark.range(300).selectExpr(
        "id AS movie_id", *[f"double(id * {7 * i + 3} % 29) AS {n}" for i, n in enumerate(names)],
        "int(id * 31 % 29 > 14) AS label",
    )
    rows = fold_column(ml.assemble(rows, names), ["movie_id"], 2).select(
        vector_to_array("features").alias("x"), F.col("label").cast("double").alias("label"), "fold"
    )
    cuts = binned_forest.Rows.of(rows).cuts(8, 0)
    stored = binned_forest.entries(rows, cuts, 0).toArrow()
    assert stored.schema.names[:2] == ["k0", "k1"]
    assert sum(stored.column("n").to_pylist()) == 300
    bins = binned_forest.bins_of(stored, 11)
    expected = {
        tuple(int(np.searchsorted(cut, v)) for cut, v in zip(cuts, r.x)) for r in rows.collect()
    }
    assert {tuple(b) for b in bins.tolist()} == expected


def test_gaps_of_dirty_rows_are_entries_of_their_own(spark):
    rows = spark.range(600).selectExpr(
        "string(id) AS tconst", "CASE WHEN id % 4 > 0 THEN double(id % 50) END AS minutes",
        "0 AS fold", "double(id % 4 = 0 OR id % 50 > 30) AS label",
    )
    dirty = missing.MissingSides(inputCols=["minutes"]).fit(rows).transform(rows)
    found = binned_forest.Rows.of(
        dirty.select(vector_to_array("features").alias("x"), "label", "fold")
    )
    cuts = found.cuts(32)
    entries = binned_forest.entries(found.df, cuts).toArrow()
    bins = binned_forest.bins_of(entries, 2)
    gap = (bins[:, 0] == 0) & (bins[:, 1] == len(cuts[1]))  # below all, above all
    assert entries.column("n").to_numpy()[gap].tolist() == [150]
    table = scoring.compare_inputs(
        {"dirty": dirty.drop("fold")}, ["tconst"], folds=2, trees=(8,), depths=(4,)
    ).first()
    assert table.accuracy > 0.95 and table.n_rows == 600
