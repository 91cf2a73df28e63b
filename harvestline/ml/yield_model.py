"""Random forest on annual predictors."""

from __future__ import annotations

import json
import logging
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from statistics import fmean

from pyspark import inheritable_thread_target
from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from harvestline import schemas
from harvestline.functions.numeric import md5_fraction, stable_round
from harvestline.operators.metrics import regression_metrics
from harvestline.operators.sets import split
from harvestline.session import scratch_path

log = logging.getLogger(__name__)

# Fixed values of the model.
NUMERIC_FEATURES = (
    "mean_ndvi",
    "max_ndvi",
    "annual_precip",
    "mean_temp",
    "annual_gdd",
    "area_ha",
)
TREES, DEPTH, SEED = 35, 6, 42
TREE_GRID, DEPTH_GRID, FOLDS = (20, 35, 50), (4, 6, 8), 5

KEYS = ("county_id", "year", "crop")
PARALLEL_FITS = 4


class NoTrainingData(ValueError):
    """The join of predictors and yields has no row."""


@dataclass(frozen=True)
class GridPoint:
    trees: int
    depth: int
    rmse: float


@dataclass(frozen=True)
class Trained:
    encoder: PipelineModel
    forest: Model
    cross_validation: list[GridPoint] | None
    metrics: DataFrame


def encoder() -> Pipeline:
    """Crop by frequency to one-hot without the last, then one feature vector."""
    return Pipeline(
        stages=[
            StringIndexer(inputCol="crop", outputCol="crop_index"),
            OneHotEncoder(inputCol="crop_index", outputCol="crop_vec"),
            VectorAssembler(inputCols=[*NUMERIC_FEATURES, "crop_vec"], outputCol="features"),
        ]
    )


def feature_names(encoding: PipelineModel) -> list[str]:
    crops = encoding.stages[0].labels
    return [*NUMERIC_FEATURES, *[f"crop_{c}" for c in crops[:-1]]]


def with_label(data: DataFrame) -> DataFrame:
    return data.withColumn("label", F.col("yield_mt_ha").cast("double"))


def forest(trees: int = TREES, depth: int = DEPTH) -> RandomForestRegressor:
    return RandomForestRegressor(
        featuresCol="features", labelCol="label", numTrees=trees, maxDepth=depth, seed=SEED
    )


def leaf_values(nodes: Sequence[Row], depths: Sequence[int]) -> dict[int, list[float]]:
    """For each depth, what the tree cut there predicts for each of its leaves, left to right.

    ``nodes`` are those of one tree by id, ``leftChild`` and ``rightChild`` -1 in a leaf.
    """
    found = {depth: [] for depth in depths}

    def walk(node: Row, level: int, above: dict[int, float]) -> None:
        here = {d: node.prediction if level <= d else above[d] for d in depths}
        if node.leftChild < 0:
            for depth, value in here.items():
                found[depth].append(value)
            return
        walk(nodes[node.leftChild], level + 1, here)
        walk(nodes[node.rightChild], level + 1, here)

    walk(nodes[0], 0, {})
    return found


def cut_errors(
    model: RandomForestRegressionModel,
    data: DataFrame,
    sizes: Sequence[int],
    depths: Sequence[int],
) -> dict[tuple[int, int], float]:
    """Root mean squared error by number of trees and depth: of the first trees, cut at the depth.

    Trees are drawn independently of each other, so the first k of them are a forest of
    k trees. They are grown level by level, and a level does not depend on those below,
    so a deep forest cut at a depth is the forest of that depth. The leaves that a row
    falls into are found once, in one pass over the data.
    """
    spark = data.sparkSession
    path = scratch_path(spark, "forest")
    model.write().save(path)
    # At most 2 ** (depth + 1) nodes a tree, whatever the data.
    saved = spark.read.parquet(f"{path}/data").select(
        "treeID", "nodeData.id", "nodeData.prediction", "nodeData.leftChild", "nodeData.rightChild"
    )
    trees: dict[int, list[Row]] = {}
    for node in sorted(saved.collect()):
        trees.setdefault(node.treeID, []).append(node)
    values = {tree: leaf_values(nodes, depths) for tree, nodes in trees.items()}

    found = model.transform(
        data.select("features", "label"), {model.leafCol: "leaf", model.predictionCol: ""}
    )
    leaves = found.select("label", vector_to_array("leaf").alias("leaves"))

    def value(tree: int, depth: int) -> Column:
        of_leaf = F.from_json(F.lit(json.dumps(values[tree][depth])), "array<double>")
        return F.get(of_leaf, F.col("leaves")[tree].cast("int"))

    steps = list(zip([0, *sorted(sizes)], sorted(sizes)))
    sums = leaves.select(
        "label",
        *[
            sum((value(t, depth) for t in range(first, last)), F.lit(0.0)).alias(f"{depth}_{last}")
            for depth in depths
            for first, last in steps
        ],
    )

    def error(k: int, depth: int) -> Column:
        mean = sum((F.col(f"{depth}_{last}") for _, last in steps if last <= k), F.lit(0.0)) / k
        return F.sqrt(F.avg(F.pow(mean - F.col("label"), 2))).alias(f"{k}_{depth}")

    errors = sums.agg(*[error(k, depth) for k in sizes for depth in depths]).first()
    return {(k, depth): errors[f"{k}_{depth}"] for k in sizes for depth in depths}


def prefix_errors(
    model: RandomForestRegressionModel, data: DataFrame, sizes: Sequence[int]
) -> dict[int, float]:
    """Root mean squared error of the first trees of a forest, for several numbers of trees."""
    depth = model.getOrDefault("maxDepth")
    return {k: error for (k, _), error in cut_errors(model, data, sizes, (depth,)).items()}


def cross_validate(train_set: DataFrame, parallelism: int) -> list[GridPoint]:
    """Mean error of every grid point over the folds.

    One forest for each fold, of as many trees and as deep as the grid has at most; the
    smaller ones are its first trees, cut. ``train_set`` has ``features``, ``label``, ``fold``.
    """

    def errors(fold: int) -> dict[tuple[int, int], float]:
        model = forest(max(TREE_GRID), max(DEPTH_GRID)).fit(train_set.filter(F.col("fold") != fold))
        held_out = train_set.filter(F.col("fold") == fold)
        return cut_errors(model, held_out, TREE_GRID, DEPTH_GRID)

    spark = train_set.sparkSession
    with ThreadPoolExecutor(parallelism) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(errors), k) for k in range(FOLDS)]
        found = [future.result() for future in running]
    return [
        GridPoint(trees, depth, fmean(fold[trees, depth] for fold in found))
        for trees in TREE_GRID
        for depth in DEPTH_GRID
    ]


def best_of(grid: list[GridPoint]) -> GridPoint:
    return min(grid, key=lambda point: point.rmse)


def train(
    data: DataFrame, use_cross_validation: bool = True, parallelism: int = PARALLEL_FITS
) -> Trained:
    """Fit on a hashed 80% of the keys, measure on the rest.

    Folds go by a hash of the key as well, so a lost task cannot move rows.
    ``data`` is read once per pass of the forest, so hand in a stored table.
    """
    if data.isEmpty():
        raise NoTrainingData("no county and year has both predictors and yields")
    encoding = encoder().fit(data)
    train_set, test_set = split(with_label(encoding.transform(data)), KEYS)
    fold = F.floor(md5_fraction(F.lit("fold"), *[F.col(k) for k in KEYS]) * FOLDS).cast("int")
    train_set = train_set.select("features", "label", fold.alias("fold")).persist()
    try:
        model, validation = _fit(train_set, use_cross_validation, parallelism)
    finally:
        train_set.unpersist()
    metrics = regression_metrics(model.transform(test_set), "label", "prediction")
    return Trained(encoding, model, validation, metrics)


def _fit(train_set: DataFrame, use_cross_validation: bool, parallelism: int):
    if use_cross_validation:
        folds = train_set.select("fold").distinct().count()
        if folds == FOLDS:
            grid = cross_validate(train_set, parallelism)
            best = best_of(grid)
            return forest(best.trees, best.depth).fit(train_set), grid
        log.warning("only %s of %s folds have rows, fitting the default forest", folds, FOLDS)
    return forest().fit(train_set), None


def cv_table(grid: list[GridPoint]) -> DataFrame:
    """Mean error of every grid point; the smallest is marked."""
    best = best_of(grid)
    rows = [(point.trees, point.depth, float(point.rmse), point is best) for point in grid]
    return SparkSession.active().createDataFrame(rows, schemas.CV_RESULTS)


def importance_table(trained: Trained) -> DataFrame:
    """Importance of every feature, then the model's error rows."""
    weights = trained.forest.featureImportances.toArray()
    rows = [(n, float(w)) for n, w in zip(feature_names(trained.encoder), weights)]
    named = trained.metrics.sparkSession.createDataFrame(rows, schemas.FEATURE_IMPORTANCE)
    errors = trained.metrics.select(
        F.explode(
            F.array(
                F.struct(F.lit("_model_rmse").alias("feature"), F.col("rmse").alias("importance")),
                F.struct(F.lit("_model_r2").alias("feature"), F.col("r2").alias("importance")),
            )
        ).alias("row")
    ).select("row.*")
    return named.unionByName(errors)


def predict_all(trained: Trained, data: DataFrame) -> DataFrame:
    """Prediction for every row, those trained on included."""
    return project_predictions(trained.forest.transform(trained.encoder.transform(data)))


def project_predictions(scored: DataFrame) -> DataFrame:
    return scored.select(
        F.col("county_id").cast("int"),
        "crop",
        F.col("year").cast("int"),
        F.col("yield_mt_ha").cast("double").alias("actual_yield"),
        stable_round(F.col("prediction"), 4).alias("predicted_yield"),
    )
