"""Feature table to trained classifier to scored files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Model, PipelineModel
from pyspark.ml.base import Estimator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom import schemas
from tabloom.operators import ml
from tabloom.operators.cleaning import split_by_subset
from tabloom.operators.encoding import feature_table
from tabloom.operators.forest_search import best_forest, search, summary
from tabloom.operators.missing import MissingSides
from tabloom.operators.ordered import number_rows
from tabloom.operators.split import hash_split
from tabloom.session import materialize
from tabloom.sources.files import write_predictions


INPUT_ORDER = tuple(schemas.PLACE.names)  # of the staged rows, by file


def film_features(
    movies: DataFrame, directing: DataFrame, writing: DataFrame
) -> DataFrame:
    """The model's input, one row per film, with the places that ``movies`` has."""
    columns = ["subset", "movie_id", "num_votes", "runtime_min", "title_length", "label"]
    places = [c for c in INPUT_ORDER if c in movies.columns]
    return feature_table(
        movies.select(*columns, *places),
        {"director": (directing, "director_id"), "writer": (writing, "writer_id")},
    )


def train_and_score(
    features: DataFrame,
    out: str,
    estimator: Estimator | None = None,
    order_by: tuple[str, ...] | None = None,
):
    """Fit on the train rows; write one CSV folder per unlabelled subset.

    The lines of a folder follow ``order_by``: by default the order of the staged
    files where the features have it (see ``film_etl.placed_movies``), else the
    ids. The feature table is stored first: tree training reads it many times,
    and a lost executor then re-reads a file instead of the joins behind it.
    """
    placed = all(c in features.columns for c in INPUT_ORDER)
    order = order_by or (INPUT_ORDER if placed else ("movie_id",))
    numbered = number_rows(features, list(order)).drop(*INPUT_ORDER)
    train, test, validation = split_by_subset(materialize(numbered, "features"))
    model = (estimator or ml.random_forest()).fit(ml.assemble(train, schemas.FEATURES))
    for name, part in (("val_result", validation), ("test_result", test)):
        scored = ml.score(model, ml.assemble(part, schemas.FEATURES), ["row_num"])
        write_predictions(scored, ["row_num"], f"{out}/{name}")
    return model


def predictions(features: DataFrame, estimator: Estimator) -> DataFrame:
    """Predictions for the validation and test rows of a stored feature table."""
    train, test, validation = split_by_subset(features)
    model = estimator.fit(ml.assemble(train, schemas.FEATURES))
    return ml.score(
        model,
        ml.assemble(validation.unionByName(test), schemas.FEATURES),
        ["movie_id"],
    ).withColumn("prediction", F.col("prediction").cast("boolean"))


def score_hidden(
    model: Model, hidden: Mapping[str, DataFrame], order_by: Sequence[str], out: str
) -> None:
    """One CSV folder of predictions per hidden frame, in the order of ``order_by``."""
    for name, rows in hidden.items():
        write_predictions(model.transform(rows), order_by, f"{out}/{name}")


def raw_baseline(
    raw: DataFrame,
    features: Sequence[str],
    key: Sequence[str],
    folds: int = 5,
    trees: Sequence[int] = ml.ACCURACY_GRID["trees"],
    depths: Sequence[int] = ml.ACCURACY_GRID["depths"],
    bins: int = 32,
) -> tuple[PipelineModel, DataFrame]:
    """A forest on raw numbers, missing values included, tuned by accuracy.

    80% of the labelled rows tune and train it, the others grade it. Returns the
    fitted pipeline, which scores raw rows, and one row: the best setting, its
    accuracy in cross-validation (of the tuned model, that is) and on the rows
    held out, and their number. ``raw`` should be stored.
    """
    parts = hash_split(raw.dropna(subset=["label"]), key)
    train, held_out = (parts.where(F.col("split") == name) for name in ("train", "test"))
    sides = MissingSides(inputCols=list(features)).fit(train)
    prepared = sides.transform(train)
    settings = summary(search(prepared, key, trees, depths, (bins,), "accuracy", folds))
    best = materialize(settings, "settings").where("best")
    model = PipelineModel([sides, best_forest(best).fit(prepared)])
    hit = (F.col("label").cast("double") == F.col("prediction")).cast("int")
    graded = model.transform(held_out).agg(
        F.avg(hit).alias("test_accuracy"), F.count("*").alias("n_test")
    )
    report = best.select(
        "num_trees", "max_depth", F.col("avg_metric").alias("cv_accuracy")
    ).join(F.broadcast(graded))  # one row and one row
    return model, report


def compare_inputs(
    inputs: Mapping[str, DataFrame],
    key: Sequence[str],
    folds: int = 5,
    trees: Sequence[int] = ml.ACCURACY_GRID["trees"],
    depths: Sequence[int] = ml.ACCURACY_GRID["depths"],
    bins: int = 32,
) -> DataFrame:
    """The best setting and its k-fold accuracy on each named prepared frame."""
    found = None
    for name, prepared in inputs.items():
        settings = summary(search(prepared, key, trees, depths, (bins,), "accuracy", folds))
        row = settings.where("best").select(
            F.lit(name).alias("input"), "num_trees", "max_depth",
            F.col("avg_metric").alias("accuracy"), F.col("n_test").alias("n_rows"),
        )
        found = row if found is None else found.unionByName(row)
    return found
