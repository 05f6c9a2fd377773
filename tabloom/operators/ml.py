"""Assembling, training, tuning, scoring and evaluation with Spark ML."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model, Pipeline
from pyspark.ml.base import Estimator
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator,
    Evaluator,
    MulticlassClassificationEvaluator,
)
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.operators import binned_forest
from tabloom.operators.ordered import running_total
from tabloom.operators.split import fold_column

SEED = 42


def assemble(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Add the ``features`` vector. Impute first: a null is an error here."""
    return VectorAssembler(inputCols=list(features), outputCol="features").transform(df)


def indexed_pipeline(features: Sequence[str], label: str = "label") -> Pipeline:
    """Assembler plus a label indexer by descending frequency."""
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=list(features), outputCol="features"),
            StringIndexer(inputCol=label, outputCol=f"{label}_index"),
        ]
    )


def index_label(df: DataFrame, label: str) -> DataFrame:
    """Add ``<label>_index``: 0 for the most frequent text, ties by name."""
    indexer = StringIndexer(inputCol=label, outputCol=f"{label}_index")
    return indexer.fit(df).transform(df)


# What the fits that run at one time may keep of their rows, in the whole cluster.
FIT_BYTES = 4_000_000_000
# Of a training row: the row in bins, and per tree its draws and its nodes at two levels.
_ROW_BYTES, _TREE_BYTES = 200, 12


def _part_trees(rows: int, trees: int) -> int:
    """Trees grown at a time: an eighth of the room for many of them, all for a few."""

    def fit_in(size: int) -> int:
        return (size // max(1, rows) - _ROW_BYTES) // _TREE_BYTES

    return min(trees, max(fit_in(FIT_BYTES // 8), min(20, fit_in(FIT_BYTES)), 5))


def fits_at_once(rows: int, trees: int) -> int:
    """How many forests may be grown side by side, one at least."""
    row = _ROW_BYTES + _part_trees(rows, trees) * _TREE_BYTES
    return max(1, FIT_BYTES // max(1, rows * row))


def forest_parts(rows: int, trees: int) -> list[int]:
    """Tree counts of the parts that a forest is grown in, one after another."""
    parts = -(-trees // _part_trees(rows, trees))
    return [trees // parts + (i < trees % parts) for i in range(parts)]


class ForestClassifier(RandomForestClassifier):
    """Spark's forest, grown over rows in bins, or in parts where these are too many.

    Trees of two classes come from ``binned_forest`` as long as its entries fit into
    every task. Others are Spark's: a fit keeps every row's draws and nodes for all
    of its trees; beyond memory they go to disk and are read again at each level.
    Trees do not depend on each other, so parts with seeds of their own make the same
    kind of forest. Pass a stored frame: it is counted and read once a part.
    """

    def _fit(self, dataset: DataFrame) -> RandomForestClassificationModel | ForestModel:
        grown = binned_forest.fit(self, dataset, FIT_BYTES)
        return grown if grown is not None else self.grown_in_parts(dataset)

    def grown_in_parts(
        self, dataset: DataFrame
    ) -> RandomForestClassificationModel | ForestModel:
        """The forest as Spark grows it."""
        parts = forest_parts(dataset.count(), self.getNumTrees())
        if len(parts) == 1:
            return super()._fit(dataset)
        seed = self.getSeed()
        grown = []
        for i, trees in enumerate(parts):
            part = self.copy({self.numTrees: trees, self.seed: seed + i})
            grown.append(super(ForestClassifier, part)._fit(dataset))
        return ForestModel(grown)


class ForestModel(Model):
    """Several forests that vote as one."""

    def __init__(self, parts: Sequence[RandomForestClassificationModel]):
        super().__init__()
        self.parts = list(parts)

    def _transform(self, df: DataFrame) -> DataFrame:
        first = self.parts[0]
        names = [f"__votes{i}" for i in range(len(self.parts))]
        out = df
        for name, part in zip(names, self.parts):
            votes = {part.rawPredictionCol: name, part.probabilityCol: "", part.predictionCol: ""}
            out = part.copy(votes).transform(out)
        sums = F.array(
            *[
                sum((vector_to_array(n)[k] for n in names), F.lit(0.0))
                for k in range(first.numClasses)
            ]
        )
        trees = F.lit(float(sum(p.getNumTrees for p in self.parts)))
        out = out.withColumn("__votes", sums).drop(*names)
        shares = F.transform("__votes", lambda v: v / trees)
        # Equal votes go to the first class, as in the classifier.
        best = F.array_position("__votes", F.array_max("__votes")) - 1
        return out.withColumns(
            {
                first.getRawPredictionCol(): array_to_vector("__votes"),
                first.getProbabilityCol(): array_to_vector(shares),
                first.getPredictionCol(): best.cast("double"),
            }
        ).drop("__votes")


def random_forest(trees: int = 300, depth: int = 10, bins: int = 20, label: str = "label"):
    return ForestClassifier(
        labelCol=label, numTrees=trees, maxDepth=depth, maxBins=bins, seed=SEED,
        # A row's node in every tree is kept, not found again at each level, and
        # not written either: the levels of one part are few.
        cacheNodeIds=True, checkpointInterval=-1,
    )


def decision_tree(label: str = "label_index"):
    return DecisionTreeClassifier(labelCol=label, seed=SEED)


def boosted_trees(depth: int = 5, iterations: int = 20, label: str = "label"):
    return GBTClassifier(labelCol=label, maxDepth=depth, maxIter=iterations, seed=SEED)


def auc_evaluator(label: str = "label") -> Evaluator:
    return BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC")


def accuracy_evaluator(label: str = "label") -> Evaluator:
    return MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy")


def forest_grid(
    estimator: RandomForestClassifier,
    trees: Sequence[int] = (100, 200, 300),
    depths: Sequence[int] = (2, 5, 10, 15),
    bins: Sequence[int] | None = (5, 10, 20, 32),
):
    """The forest settings to try: by default 3 x 4 x 4."""
    grid = ParamGridBuilder().addGrid(estimator.numTrees, list(trees))
    grid = grid.addGrid(estimator.maxDepth, list(depths))
    if bins:
        grid = grid.addGrid(estimator.maxBins, list(bins))
    return grid.build()


#: The settings of the raw-data baseline.
ACCURACY_GRID = {"trees": (50, 100, 200, 300), "depths": (2, 4, 6, 8)}


def tune(
    prepared: DataFrame,
    estimator: Estimator,
    grid: list,
    evaluator: Evaluator,
    key: Sequence[str],
    folds: int = 5,
    parallelism: int = 4,
) -> CrossValidatorModel:
    """Cross-validated search with folds fixed by the row key.

    Pass a stored frame: it is read once per fold and setting.
    """
    return CrossValidator(
        estimator=estimator,
        estimatorParamMaps=grid,
        evaluator=evaluator,
        numFolds=folds,
        foldCol="fold",
        seed=SEED,
        parallelism=parallelism,
    ).fit(fold_column(prepared, key, folds, SEED))


def tuning_report(model: CrossValidatorModel, spark) -> DataFrame:
    """One row per setting with its mean metric; one row per setting of a grid."""
    rows = [
        (
            ", ".join(sorted(f"{p.name}={v}" for p, v in setting.items())) or "fixed",
            float(metric),
        )
        for setting, metric in zip(model.getEstimatorParamMaps(), model.avgMetrics)
    ]
    return spark.createDataFrame(rows, "setting string, avg_metric double")


def score(model: Model, prepared: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Batch predictions beside the ``keep`` columns."""
    return model.transform(prepared).select(*keep, "prediction")


def accuracy(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """One row: the share of rows whose prediction equals the label."""
    hit = (F.col(label).cast("double") == F.col(prediction).cast("double")).cast("int")
    return df.agg(F.avg(hit).alias("accuracy"))


def auc(
    df: DataFrame, label: str, score: str, by: Sequence[str] = (), weight: str | None = None
) -> DataFrame:
    """The exact area under the ROC curve of a score: one row, or one per group.

    Rows are merged per score first; the ranks come from ``running_total``.
    ``weight`` names a whole number, the rows that one stands for.
    """
    by = list(by)
    each = F.col(weight) if weight else F.lit(1)
    positive = F.sum(F.when(F.col(label).cast("boolean"), each).otherwise(0))
    per_score = df.dropna(subset=[label, score]).groupBy(*by, score).agg(
        positive.alias("pos"), (F.sum(each) - positive).alias("neg")
    )
    below = running_total(
        per_score, [score], partition_by=by, weight="neg", name="neg_below"
    )
    wins = F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") / 2))
    return below.groupBy(*by).agg(
        F.try_divide(wins, F.sum("pos").cast("double") * F.sum("neg")).alias("auc")
    )
