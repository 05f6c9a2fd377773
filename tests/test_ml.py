import inspect

import numpy as np
import pytest
from conftest import rows
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabloom import schemas
from tabloom.operators import forest_search, missing, ml
from tabloom.operators.split import fold_column
from tabloom.plans import catalog, scoring
from tabloom.plans.film_dataset import DATASET_FEATURES, FilmFeatures

SEARCH = forest_search.search


def films(spark, n=400):
    """Films whose label follows the director score, with some noise."""
    return spark.range(n).selectExpr(
        "id AS movie_id",
        "CASE WHEN id % 10 < 8 THEN 'train' WHEN id % 10 = 8 THEN 'val' ELSE 'test' END AS subset",
        "int(id * 7 % 100) AS num_votes",
        "int(60 + id % 90) AS runtime_min",
        "5 AS title_length",
        "CASE WHEN id % 10 < 8 THEN id % 2 = 0 END AS label",
    )


def test_train_and_score(spark, tmp_path):
    directing = spark.range(400).selectExpr("id AS movie_id", "id % 6 AS director_id")
    writing = spark.range(0, 400, 2).selectExpr("id AS movie_id", "id % 11 AS writer_id")
    features = scoring.film_features(films(spark), directing, writing)
    out = str(tmp_path)
    model = scoring.train_and_score(features, out, ml.random_forest(5, 3, 20))
    assert model.getNumTrees == 5
    for name in ("val_result", "test_result"):
        written = spark.read.schema("label boolean").csv(f"{out}/{name}")
        assert written.count() == 40
        assert written.where("label is null").count() == 0
    train = ml.assemble(features.where("subset = 'train'"), schemas.FEATURES)
    scored = model.transform(train)
    assert ml.accuracy(scored, "label").first().accuracy > 0.9


def test_forest_parts_are_bounded():
    for rows in (0, 1, 1_000, 400_000, 4_000_000, 30_000_000):
        parts = ml.forest_parts(rows, 300)
        assert sum(parts) == 300 and min(parts) >= 5
        kept = rows * (200 + 12 * max(parts)) * ml.fits_at_once(rows, 300)
        assert kept <= max(ml.FIT_BYTES, rows * (200 + 12 * 5))
    assert ml.forest_parts(100_000, 300) == [300]
    assert len(ml.forest_parts(4_000_000, 300)) == 15


def test_a_forest_in_parts_votes_as_one(spark, monkeypatch):
    prepared = ml.assemble(
        spark.range(300).selectExpr(
            "double(id % 17) AS a", "double(id % 23) AS b", "int((id % 17 + id % 23) > 18) AS label"
        ),
        ["a", "b"],
    )
    forest = ml.random_forest(11, 4, 8)
    assert forest.fit(prepared).getNumTrees == 11  # one part: Spark's own model
    monkeypatch.setattr(ml, "FIT_BYTES", 1)
    model = forest.fit(prepared)
    assert [p.getNumTrees for p in model.parts] == [4, 4, 3]
    scored = model.transform(prepared)
    got = scored.select(vector_to_array("probability")[1].alias("p"), "prediction").collect()
    by_part = [
        [r.p for r in p.transform(prepared).select(vector_to_array("probability")[1].alias("p")).collect()]
        for p in model.parts
    ]
    share = np.average(by_part, axis=0, weights=[4, 4, 3])
    assert np.allclose([r.p for r in got], share)
    assert [r.prediction for r in got] == [float(p > 0.5) for p in share]
    # The node tables of the parts are one forest too.
    nodes = forest_search.NodeTable.of(model, spark)
    x = np.array(prepared.select(vector_to_array("features").alias("x")).toPandas().x.tolist())
    assert np.allclose(forest_search.scores(x, nodes, [11], [4])[:, 0, 0], share)
    assert {"rawPrediction", "probability", "prediction"} == set(scored.columns) - set(prepared.columns)


def test_index_label_ties_break_by_name(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "x string")
    got = {r.x: r.x_index for r in ml.index_label(df, "x").collect()}
    assert got == {"c": 0.0, "a": 1.0, "b": 2.0}


def test_auc_equals_the_evaluator(spark):
    df = spark.range(500).select(
        ((F.col("id") * 37) % 101).cast("double").alias("score"),
        ((F.col("id") * 53 + F.col("id") % 7) % 2).cast("int").alias("label"),
    )
    expected = BinaryClassificationEvaluator(
        rawPredictionCol="score", labelCol="label", numBins=0
    ).evaluate(df)
    assert ml.auc(df, "label", "score").first().auc == pytest.approx(expected)


def numbers(spark, n=300):
    return spark.range(n).selectExpr(
        "id AS movie_id", "double(id % 2) AS good", "double(id % 3) AS noise",
        "double(id * 7919 % 101) AS more", "int(id % 2) AS label",
    ).repartition(2)


def test_tuning(spark):
    prepared = ml.assemble(numbers(spark), ["good", "noise"])
    forest = ml.random_forest(3, 2, 8)
    grid = ml.forest_grid(forest, trees=(2, 3), depths=(1, 2), bins=(4,))
    model = ml.tune(prepared, forest, grid, ml.auc_evaluator(), ["movie_id"], folds=2)
    assert ml.tuning_report(model, spark).count() == 4


def test_comparison(spark):
    table = scoring.compare_inputs(
        {
            "dirty": ml.assemble(numbers(spark), ["noise"]),
            "clean": ml.assemble(numbers(spark), ["good", "noise"]),
        },
        ["movie_id"], folds=2, trees=(2, 3), depths=(1, 2), bins=8,
    )
    got = {r.input: r for r in table.collect()}
    assert got["clean"].accuracy > 0.95 > got["dirty"].accuracy
    assert got["clean"].n_rows == 300


@pytest.mark.parametrize("depth", [0, 1, 2, 4, 6])
def test_a_forest_cut_short_scores_as_one_grown_to_that_depth(spark, depth):
    rows = numbers(spark, 600).withColumn(
        "label", F.expr("int((good + noise * more + movie_id * 13 % 7) % 5 > 2)")
    )
    prepared = ml.assemble(rows, ["good", "noise", "more"]).coalesce(1)

    def grown(limit):
        return RandomForestClassifier(
            numTrees=7, maxDepth=limit, maxBins=16, seed=1, featureSubsetStrategy="all"
        ).fit(prepared)

    nodes = forest_search.NodeTable.of(grown(6), spark)
    tested = grown(depth).transform(prepared).select(
        vector_to_array("features").alias("x"), vector_to_array("probability")[1].alias("p")
    ).collect()
    x = np.array([r.x for r in tested])
    got = forest_search.scores(x, nodes, [3, 7], [6, depth])
    assert got.shape == (600, 2, 2)
    assert got[:, 1, 1] == pytest.approx([r.p for r in tested], abs=1e-12)


def test_search_grades_as_the_evaluators_do(spark):
    rows = numbers(spark, 500).withColumn("label", F.expr("int(more + noise * 20 > 60)"))
    prepared = ml.assemble(rows, ["good", "noise", "more"])
    asked = {"trees": (1, 4), "depths": (1, 3), "bins": (4, 8), "folds": 3}
    areas = forest_search.search(prepared, ["movie_id"], **asked).collect()
    hits = forest_search.search(prepared, ["movie_id"], metric="accuracy", **asked)
    assert len(areas) == hits.count() == 2 * 2 * 2 * 3
    assert {r.n_test for r in areas} == {
        r["count"] for r in fold_column(rows, ["movie_id"], 3).groupBy("fold").count().collect()
    }
    assert all(0.4 < r.metric <= 1 for r in areas)
    settings = forest_search.summary(hits)
    assert settings.count() == 8 and settings.where("best").count() == 1
    best = settings.where("best").first()
    assert best.avg_metric == max(r.avg_metric for r in settings.collect())
    forest = forest_search.best_forest(settings)
    assert (forest.getNumTrees(), forest.getMaxDepth()) == (best.num_trees, best.max_depth)
    assert best.n_test == 500


def test_search_refuses_what_it_cannot_score(spark):
    three = ml.assemble(numbers(spark).withColumn("label", F.expr("movie_id % 3")), ["good"])
    with pytest.raises(ValueError):
        forest_search.search(three, ["movie_id"], (1,), (1,), (4,), folds=2)
    with pytest.raises(ValueError):
        forest_search.search(three, ["movie_id"], metric="loss")


def test_missing_values_go_to_the_side_that_a_split_learns(spark, tmp_path):
    # Missing minutes mean yes although high ones do and low ones do not.
    rows = spark.range(400).selectExpr(
        "id AS movie_id",
        "CASE WHEN id % 4 > 0 THEN double(id % 100) END AS minutes",
        "string(id % 10) AS votes",
        "int(id % 4 = 0 OR id % 100 > 60) AS label",
    )
    sides = missing.MissingSides(inputCols=["minutes", "votes"]).fit(rows)
    prepared = sides.transform(rows)
    assert prepared.columns == [*rows.columns, "features"]
    assert len(prepared.first().features) == 3  # votes has no gap
    tree = ml.decision_tree("label").setMaxDepth(1).fit(prepared)
    assert ml.accuracy(tree.transform(prepared), "label").first().accuracy > 0.98
    sides.write().save(str(tmp_path / "sides"))
    again = missing.MissingSidesModel.load(str(tmp_path / "sides"))
    late = spark.createDataFrame([(None, None)], "minutes double, votes string")
    assert again.transform(late).first().features == sides.transform(late).first().features


def test_the_raw_baseline_scores_files_in_their_order(spark, tmp_path):
    raw = spark.range(500).selectExpr(
        "string(id) AS tconst",
        "CASE WHEN id % 5 > 0 THEN double(id * 31 % 100) END AS minutes",
        "double(id % 3) AS votes",
        "CASE WHEN id < 490 THEN int(id % 5 > 0 AND id * 31 % 100 > 50) END AS label",
    )
    model, report = scoring.raw_baseline(
        raw, ["minutes", "votes"], ["tconst"], folds=2, trees=(5, 9), depths=(2, 4)
    )
    row = report.first()
    assert row.cv_accuracy > 0.95 and row.test_accuracy > 0.95 and 60 < row.n_test < 140
    hidden = spark.range(100).selectExpr(
        "id AS place", "double(id * 37 % 100) AS minutes", "0D AS votes"
    )
    scoring.score_hidden(model, {"val": hidden.repartition(3)}, ["place"], str(tmp_path))
    parts = sorted((tmp_path / "val").glob("part-*.csv"))
    lines = [line for p in parts for line in p.read_text().split()]
    right = sum((x == "true") == (i * 37 % 100 > 50) for i, x in enumerate(lines))
    assert len(lines) == 100 and right >= 95


def test_dataset_features_are_a_stage_that_can_be_stored(spark, tmp_path):
    raw = spark.range(200).selectExpr(
        "id AS movie_id", "concat('Film ', id % 9) AS primary_title",
        "concat('Film ', id % 7) AS original_title", "string(1990 + id % 20) AS start_year",
        "CAST(NULL AS STRING) AS end_year", "string(60 + id % 50) AS runtime_min",
        "CASE WHEN id % 6 > 0 THEN string(id) END AS num_votes", "id % 2 = 0 AS label",
    )
    directing = spark.range(200).selectExpr("id AS movie_id", "id % 6 AS director_id")
    writing = spark.range(200).selectExpr("id AS movie_id", "id % 11 AS writer_id")
    pipeline = Pipeline(
        stages=[
            FilmFeatures(directing, writing),
            missing.MissingSides(inputCols=DATASET_FEATURES),
            ml.boosted_trees(iterations=3),
        ]
    )
    model = pipeline.fit(raw.where("movie_id < 150").withColumn("label", F.expr("int(label)")))
    model.write().save(str(tmp_path / "model"))
    hidden = raw.where("movie_id >= 150").drop("label")
    picked = ["movie_id", "prediction"]
    expected = rows(model.transform(hidden), *picked)
    again = PipelineModel.load(str(tmp_path / "model"))
    assert rows(again.transform(hidden), *picked) == expected
    assert len(expected) == 50


def test_default_grid_size():
    forest = ml.random_forest()
    assert len(ml.forest_grid(forest)) == 48
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getMaxBins()) == (300, 10, 20)


class Asked(Exception):
    """Carries the settings that a query would train with."""


def test_registered_queries_have_the_reference_settings(spark, monkeypatch):
    def asked(name):
        def stop(*args, **more):
            raise Asked(name, args, more)

        return stop

    monkeypatch.setattr(forest_search, "search", asked("search"))
    monkeypatch.setattr(scoring, "search", asked("search"))
    monkeypatch.setattr(scoring, "predictions", asked("predictions"))
    nothing = spark.createDataFrame([], "movie_id long, features string, label int")
    monkeypatch.setattr(catalog, "_labelled", lambda spark, folder: nothing)
    monkeypatch.setattr(catalog, "_features", lambda spark, folder: None)
    with pytest.raises(Asked) as found:
        catalog.QUERIES["tune_rf"](spark, "")
    assert found.value.args[2] == {}  # the defaults
    defaults = inspect.signature(SEARCH).parameters
    assert [defaults[n].default for n in ("trees", "depths", "bins", "folds", "metric")] == [
        (100, 200, 300), (2, 5, 10, 15), (5, 10, 20, 32), 5, "auc",
    ]
    with pytest.raises(Asked) as found:
        catalog.QUERIES["kfold_accuracy"](spark, "")
    grid = {"trees": (50, 100, 200, 300), "depths": (2, 4, 6, 8)}
    assert grid.items() <= found.value.args[2].items()
    for name in ("compare_dirty_clean", "holdout_accuracy"):
        with pytest.raises(Asked) as found:
            catalog.QUERIES[name](spark, "/root/testdata/sf0.001")
        assert found.value.args[1][2:] == (*grid.values(), (32,), "accuracy", 5)
    with pytest.raises(Asked) as found:
        catalog.QUERIES["score_rf"](spark, "")
    forest = found.value.args[1][1]
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getMaxBins()) == (300, 10, 20)
