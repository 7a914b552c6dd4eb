"""Classifiers: training, cross-validation, search, batch prediction, importances, saving.

Settings carry the usual names (``C``, ``n_estimators``, ``max_depth`` ...) and are translated here.
MLlib has no minimum number of rows to split a node, and its trees go at most 30 levels deep.
"""

from __future__ import annotations

import json
import math
import random
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from itertools import product
from statistics import fmean, stdev
from typing import Any

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfsight.operators import boosting
from shelfsight.operators.features import feature_names
from shelfsight.operators.sampling import stratified_folds, uniform_sample
from shelfsight.session import broadcast_if_small, shared_folder

DEEPEST = 30
# Trees keep one number per feature and row, zeros too: rows of one task at most, and their numbers together.
TASK_ROWS, TASK_NUMBERS = 100_000, 20_000_000
WEIGHT = "class_weight"
FOLD = "fold"


def with_class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Weights inverse to class size, averaging 1."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    summary = counts.agg(F.sum("_n").alias("rows"), F.count(F.lit(1)).alias("classes")).first()
    weights = broadcast_if_small(
        counts.select(F.col(label).alias("_c"), (F.lit(summary["rows"]) / (summary["classes"] * F.col("_n"))).alias(WEIGHT))
    )
    return df.join(weights, df[label] == weights["_c"], "left").drop("_c")


def logistic_regression(rows: int, label: str = "label", C: float = 1.0, max_iter: int = 1000, balanced: bool = False):
    """``C`` weighs the summed loss; MLlib's penalty weighs the mean loss, so ``rows`` enters."""
    model = LogisticRegression(
        featuresCol="features", labelCol=label, regParam=1.0 / (C * max(rows, 1)), elasticNetParam=0.0,
        standardization=False, maxIter=max_iter, tol=1e-4,
    )
    return model.setWeightCol(WEIGHT) if balanced else model


def _depth(max_depth: int | None) -> int:
    """None is as deep as MLlib goes; a deeper limit cannot be kept and is refused."""
    if max_depth is not None and max_depth > DEEPEST:
        raise ValueError(f"trees are at most {DEEPEST} levels deep, not {max_depth}")
    return DEEPEST if max_depth is None else max_depth


def random_forest(
    label: str = "label", n_estimators: int = 300, max_depth: int | None = None, min_samples_leaf: int = 1,
    max_features: str | float | None = "sqrt", bootstrap: bool = True, balanced: bool = False, seed: int = 42,
):
    model = RandomForestClassifier(
        featuresCol="features", labelCol=label, numTrees=n_estimators,
        maxDepth=_depth(max_depth), minInstancesPerNode=min_samples_leaf,
        featureSubsetStrategy="all" if max_features is None else str(max_features), bootstrap=bootstrap, seed=seed,
    )
    return model.setWeightCol(WEIGHT) if balanced else model


def gradient_boosting(
    label: str = "label", n_estimators: int = 300, learning_rate: float = 0.05, max_depth: int = 3,
    subsample: float = 1.0, min_samples_leaf: int = 1, seed: int = 42,
):
    return GBTClassifier(
        featuresCol="features", labelCol=label, maxIter=n_estimators, stepSize=learning_rate, maxDepth=max_depth,
        subsamplingRate=subsample, minInstancesPerNode=min_samples_leaf, seed=seed,
    )


def majority_label(df: DataFrame, label: str = "label") -> Any:
    """The most frequent label, the smallest on ties."""
    row = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n")).orderBy(
        F.desc("n"), label).first()
    return None if row is None else row[label]


def majority_baseline(train: DataFrame, test: DataFrame, label: str = "label") -> DataFrame:
    """``test`` with the training majority as prediction."""
    return test.withColumn("prediction", F.lit(majority_label(train, label)))


# How each setting is called in MLlib.
NAMES = {
    "random_forest": {
        "n_estimators": "numTrees", "max_depth": "maxDepth", "min_samples_leaf": "minInstancesPerNode",
        "max_features": "featureSubsetStrategy", "bootstrap": "bootstrap",
    },
    "gradient_boosting": {
        "n_estimators": "maxIter", "learning_rate": "stepSize", "max_depth": "maxDepth",
        "subsample": "subsamplingRate", "min_samples_leaf": "minInstancesPerNode",
    },
}

# Search spaces.
FOREST_GRID = {
    "n_estimators": [100, 200, 300], "max_depth": [None, 10, 20], "min_samples_leaf": [1, 2],
    "class_weight": [None, "balanced"],
}
FOREST_SPACE = {
    "n_estimators": [50, 100, 150, 200, 300, 400, 500], "max_depth": [None, 5, 10, 15, 20, 30],
    "min_samples_leaf": [1, 2, 4, 8], "max_features": ["sqrt", "log2", None], "class_weight": [None, "balanced"],
}
BOOSTING_SPACE = {
    "n_estimators": [100, 150, 200, 250, 300, 400], "learning_rate": [0.01, 0.02, 0.03, 0.05, 0.08, 0.10, 0.15],
    "max_depth": [2, 3, 4, 5], "subsample": [0.7, 0.8, 0.9, 1.0], "min_samples_leaf": [1, 2, 4],
}
BOOSTING_GRIDS = {
    "large": {"n_estimators": [150, 250], "learning_rate": [0.03, 0.05], "max_depth": [2, 3], "subsample": [0.8, 1.0]},
    "medium": {"n_estimators": [150, 250], "learning_rate": [0.03, 0.05], "max_depth": [2, 3]},
    "small": {
        "n_estimators": [150, 250, 350], "learning_rate": [0.02, 0.05, 0.08], "max_depth": [2, 3, 4],
        "subsample": [0.8, 1.0],
    },
}
MAX_TUNE_ROWS = 120_000


def combinations_of(grid: Mapping[str, Sequence]) -> list[dict[str, Any]]:
    return [dict(zip(grid, values)) for values in product(*grid.values())]


def random_combinations(space: Mapping[str, Sequence], n_iter: int, seed: int = 42) -> list[dict[str, Any]]:
    """``n_iter`` different combinations (all, if there are fewer)."""
    everything = combinations_of(space)
    return random.Random(seed).sample(everything, min(n_iter, len(everything)))


def _param_map(estimator: Estimator, kind: str, settings: Mapping[str, Any]) -> dict:
    mapped = {}
    for name, value in settings.items():
        if name == "class_weight":
            mapped[estimator.getParam("weightCol")] = WEIGHT if value == "balanced" else "_unit_weight"
            continue
        if name == "max_depth":
            value = _depth(value)
        if name == "max_features":
            value = "all" if value is None else str(value)
        mapped[estimator.getParam(NAMES[kind][name])] = value
    return mapped


def _evaluator(label: str, scoring: str) -> MulticlassClassificationEvaluator:
    if scoring == "f1_weighted":
        return MulticlassClassificationEvaluator(labelCol=label, metricName="f1")
    return MulticlassClassificationEvaluator(labelCol=label, metricName="fMeasureByLabel", metricLabel=1.0)


def tree_tasks(df: DataFrame) -> int:
    """The number of tasks over which the rows trees learn from are dealt, by their number and width."""
    first = df.select("features").first()
    rows, width = df.count(), 0 if first is None else len(first["features"])
    return max(1, math.ceil(rows / TASK_ROWS), math.ceil(rows * width / TASK_NUMBERS))


def spread(df: DataFrame) -> DataFrame:
    """``df`` evenly in the partitions :func:`tree_tasks` says; a file's split may hold millions of sparse rows, another none."""
    tasks = tree_tasks(df)
    return df if tasks == 1 else df.repartition(tasks)


def _has_trees(estimator: Estimator) -> bool:
    last = estimator.getStages()[-1] if isinstance(estimator, Pipeline) else estimator
    return isinstance(last, (GBTClassifier, RandomForestClassifier))


def _read_by(estimator: Estimator) -> list[str]:
    """The columns a classifier learns from."""
    weight = [estimator.getWeightCol()] if estimator.isSet("weightCol") else []
    return [estimator.getFeaturesCol(), estimator.getLabelCol(), *weight]


def fit(estimator: Estimator, df: DataFrame) -> Model:
    """The fitted model without its training summary; the rows of trees are dealt over enough tasks.

    Boosted trees grow over sparse rows (:mod:`.boosting`). Of other trees, rows that have a fold were dealt with it; others
    are dealt once and kept on disk while the fit goes over them, as memory is wanted for the trees' own copy.

    A summary holds on to the session and to all that the session observes, which no task can be sent; a model with one
    stops working once any write of the session has been observed. Saving and loading leaves the summary behind.
    """
    needed = df if isinstance(estimator, Pipeline) else df.select(*_read_by(estimator))
    if boosting.grows(estimator):
        return boosting.fit(estimator, needed)
    dealt = spread(needed) if FOLD not in df.columns and "features" in df.columns and _has_trees(estimator) else needed
    if dealt is needed:
        fitted = estimator.fit(needed)
    else:
        dealt.persist(StorageLevel.DISK_ONLY)
        try:
            fitted = estimator.fit(dealt)
        finally:
            dealt.unpersist()
    if isinstance(fitted, PipelineModel):
        return PipelineModel([_without_summary(stage, df) for stage in fitted.stages])
    return _without_summary(fitted, df)


def fits_at_a_time(folded: DataFrame, most: int) -> int:
    """How many fits may run together: each keeps a copy of its rows, so another one starts only where cores would be idle."""
    cores = folded.sparkSession.sparkContext.defaultParallelism
    return max(1, min(most, cores // max(1, folded.rdd.getNumPartitions())))


def _without_summary(fitted: Model, df: DataFrame) -> Model:
    if not getattr(fitted, "hasSummary", False):
        return fitted
    path = shared_folder(df.sparkSession, "fitted")
    fitted.write().save(path)
    return type(fitted).load(path)


def staged_confusion(fitted: GBTClassificationModel, df: DataFrame, stages: Sequence[int], label: str = "label") -> dict[int, dict[str, int]]:
    """Confusion counts (``tp``, ``fp``, ``fn``, ``tn``) of a boosted model cut to its first n trees, for each n of ``stages``.

    Boosting adds trees one by one, so the first n trees are the model of n rounds. The leaves a row falls into are
    found once; running sums over what they add give the class at every stage, in one pass over ``df``.
    """
    spark = df.sparkSession
    path = shared_folder(spark, "staged")
    fitted.write().save(path)
    nodes = spark.read.parquet(f"{path}/data").where("nodeData.leftChild < 0")
    leaves: dict[int, list[float]] = {}
    for row in nodes.select("treeID", "nodeData.id", "nodeData.prediction").orderBy("treeID", "id").collect():
        leaves.setdefault(row["treeID"], []).append(row["prediction"] * fitted.treeWeights[row["treeID"]])
    values = F.from_json(F.lit(json.dumps([leaves[t] for t in sorted(leaves)])), "array<array<double>>")
    marked = fitted.copy({fitted.leafCol: "_leaf"})
    added = F.zip_with(vector_to_array("_leaf"), values, lambda leaf, adds: F.element_at(adds, (leaf + 1).cast("int")))
    rows = marked.transform(df.select("features", label)).select((F.col(label) == 1).alias("good"), added.alias("added"))
    sums = []
    for n in stages:
        margin = F.aggregate(F.slice("added", 1, n), F.lit(0.0), lambda total, x: total + x)
        sums.append((margin > 0).alias(f"p{n}"))
    said = rows.select("good", *sums)
    counts = said.agg(*[
        F.count_if(F.col(f"p{n}").eqNullSafe(p) & F.col("good").eqNullSafe(g)).alias(f"{name}{n}")
        for n in stages for name, p, g in (("tp", True, True), ("fp", True, False), ("fn", False, True), ("tn", False, False))
    ]).first()
    return {n: {name: counts[f"{name}{n}"] for name in ("tp", "fp", "fn", "tn")} for n in stages}


def _f1_of(counts: Mapping[str, int], scoring: str) -> float:
    def f1(hit: int, wrong: int, missed: int) -> float:
        return 2 * hit / (2 * hit + wrong + missed) if hit else 0.0

    good = f1(counts["tp"], counts["fp"], counts["fn"])
    if scoring != "f1_weighted":
        return good
    bad = f1(counts["tn"], counts["fn"], counts["fp"])
    n_good, n_bad = counts["tp"] + counts["fn"], counts["tn"] + counts["fp"]
    return (n_good * good + n_bad * bad) / (n_good + n_bad) if n_good + n_bad else 0.0


def _fold_scores(
    folded: DataFrame, estimator: Estimator, kind: str | None, candidates: Sequence[Mapping[str, Any]], label: str, folds: int, scoring: str, parallelism: int
) -> list[list[float]]:
    """The score of each candidate in each fold.

    Boosted candidates that differ in their number of rounds only are one fit, at the largest number.
    """
    staged = isinstance(estimator, GBTClassifier)
    groups: dict[str, list[int]] = {}
    for i, candidate in enumerate(candidates):
        same = {k: v for k, v in candidate.items() if not (staged and k == "n_estimators")}
        groups.setdefault(json.dumps(same, sort_keys=True) if staged else str(i), []).append(i)
    scores = [[0.0] * folds for _ in candidates]

    @inheritable_thread_target(folded.sparkSession)
    def one(task: tuple[int, list[int]]) -> None:
        fold, members = task
        train, test = folded.where(F.col(FOLD) != fold), folded.where(F.col(FOLD) == fold)
        if staged:
            rounds = {i: candidates[i].get("n_estimators", estimator.getMaxIter()) for i in members}
            longest = max(members, key=rounds.get)
            fitted = fit(estimator.copy(_param_map(estimator, kind, candidates[longest])), train)
            found = staged_confusion(fitted, test, sorted(set(rounds.values())), label)
            for i in members:
                scores[i][fold] = _f1_of(found[rounds[i]], scoring)
        else:
            (i,) = members
            fitted = fit(estimator.copy(_param_map(estimator, kind, candidates[i])), train)
            scores[i][fold] = _evaluator(label, scoring).evaluate(fitted.transform(test))

    # Other models than trees keep a narrow copy only, and many short passes that leave cores idle at their ends.
    least = 1 if _has_trees(estimator) else min(2, parallelism)
    with ThreadPoolExecutor(max(least, fits_at_a_time(folded, parallelism))) as pool:
        list(pool.map(one, [(fold, members) for fold in range(folds) for members in groups.values()]))
    return scores


def _folded(df: DataFrame, estimator: Estimator, label: str, ids: Sequence[str], folds: int, seed: int) -> DataFrame:
    """What fits read of ``df``, with the fold of each row."""
    tasks = tree_tasks(df) if _has_trees(estimator) else None
    weights = [c for c in (WEIGHT, "_unit_weight") if c in df.columns]
    return stratified_folds(df, label, ids, folds, seed, tasks).select("features", label, *weights, FOLD)


def search(
    df: DataFrame, estimator: Estimator, kind: str, candidates: Sequence[Mapping[str, Any]], ids: Sequence[str],
    label: str = "label", folds: int = 3, scoring: str = "f1_weighted", seed: int = 42, parallelism: int = 4,
) -> tuple[DataFrame, Model]:
    """Cross-validated candidates, best first, and the best one trained on all of ``df``.

    Folds are exact and stratified, and are fixed before the first fit.
    """
    spark = df.sparkSession
    ready = df.withColumn("_unit_weight", F.lit(1.0))
    if any("class_weight" in c for c in candidates):
        ready = with_class_weights(ready, label)
    folded = _folded(ready, estimator, label, ids, folds, seed).persist()
    try:
        folded.count()  # All fits read it; together they would wait for each other's blocks.
        scores = _fold_scores(folded, estimator, kind, candidates, label, folds, scoring, parallelism)
        rows = [(kind, json.dumps(c, sort_keys=True), fmean(s), stdev(s)) for c, s in zip(candidates, scores, strict=True)]
        best = max(range(len(rows)), key=lambda i: rows[i][2])
        fitted = fit(estimator.copy(_param_map(estimator, kind, candidates[best])), folded)
    finally:
        folded.unpersist()
    results = spark.createDataFrame(rows, "model string, params string, mean_score double, std_score double")
    return results.orderBy(F.desc("mean_score"), "params"), fitted


def cross_validate(
    df: DataFrame, estimator: Estimator, ids: Sequence[str], label: str = "label", folds: int = 5,
    scoring: str = "f1", seed: int = 42, parallelism: int = 4,
) -> tuple[float, float]:
    """Mean and sample deviation of the score over stratified folds.

    A logistic regression that was made for all of ``df`` keeps its C: its penalty follows the rows a fold trains on.
    """
    if isinstance(estimator, LogisticRegression):
        estimator = estimator.copy({estimator.regParam: estimator.getRegParam() * folds / (folds - 1)})
    folded = _folded(df, estimator, label, ids, folds, seed).persist()
    try:
        folded.count()
        (scores,) = _fold_scores(folded, estimator, None, [{}], label, folds, scoring, parallelism)
    finally:
        folded.unpersist()
    return fmean(scores), stdev(scores)


def grid_search(
    df: DataFrame, kind: str, ids: Sequence[str], label: str = "label", grid: str | Mapping[str, Sequence] = "small", max_rows=None, **options
):
    """Every combination of a grid: given as such, or one of ``BOOSTING_GRIDS`` by its name (forests have one grid).

    Whatever the size of the data, the grid is the one asked for. With ``max_rows``, candidates are compared on a
    uniform sample of that many rows.
    """
    boosting = kind == "gradient_boosting"
    if isinstance(grid, str):
        grid = BOOSTING_GRIDS[grid] if boosting else FOREST_GRID
    candidates, estimator = combinations_of(grid), gradient_boosting(label) if boosting else random_forest(label)
    rows = df.count() if max_rows else 0
    return search(_tuning_rows(df, rows, ids, max_rows), estimator, kind, candidates, ids, label, **options)


def random_search(
    df: DataFrame, kind: str, ids: Sequence[str], label: str = "label", space=None, n_iter: int = 20, max_rows=None,
    seed: int = 42, **options,
):
    """``n_iter`` random combinations of a space."""
    boosting = kind == "gradient_boosting"
    candidates = random_combinations(space or (BOOSTING_SPACE if boosting else FOREST_SPACE), n_iter, seed)
    estimator = gradient_boosting(label) if boosting else random_forest(label)
    rows = df.count() if max_rows else 0
    return search(_tuning_rows(df, rows, ids, max_rows), estimator, kind, candidates, ids, label, seed=seed, **options)


def _tuning_rows(df: DataFrame, rows: int, ids: Sequence[str], max_rows: int | None) -> DataFrame:
    return uniform_sample(df, ids, max_rows) if max_rows and rows > max_rows else df


def compare_searches(results: DataFrame) -> DataFrame:
    """(model, strategy, mean_score, std_score) rows with the gain over the model's base run, best first."""
    base = results.where("strategy = 'base'").select("model", F.col("mean_score").alias("_base"))
    return (
        results.join(base, "model", "left")
        .withColumn("delta", F.col("mean_score") - F.col("_base")).drop("_base")
        .orderBy(F.desc("mean_score"), "model", "strategy")
    )


def top_results(results: DataFrame, n: int = 15) -> DataFrame:
    return results.select("params", "mean_score", "std_score").orderBy(F.desc("mean_score"), "params").limit(n)


def predict(df: DataFrame, fitted: PipelineModel | Model, name: str | None = None) -> DataFrame:
    """Predicted class and both class probabilities, with the model's name; every row keeps its columns."""
    last = fitted.stages[-1] if isinstance(fitted, PipelineModel) else fitted
    scored = fitted.transform(df)
    chance = vector_to_array("probability")
    return scored.withColumns({
        "is_recommended": F.col("prediction").cast("int"), "probability_recommended": chance[1],
        "probability_not_recommended": chance[0], "model": F.lit(name or type(last).__name__),
    })


def evaluation_rows(scored: DataFrame, label: str, model: str | None = None) -> DataFrame:
    """Predictions in the (label, prediction, score) form the evaluation queries take."""
    rows = scored.select(
        F.col(label).cast("double").alias("label"), F.col("prediction").cast("double").alias("prediction"),
        vector_to_array("probability")[1].alias("score"),
    )
    return rows if model is None else rows.withColumn("model", F.lit(model))


def importances(fitted: Model, transformed: DataFrame, n: int | None = 15) -> DataFrame:
    """Features by importance, named after the columns they came from."""
    names = feature_names(transformed)
    pairs = list(zip(names, fitted.featureImportances.toArray().tolist()))
    rows = transformed.sparkSession.createDataFrame(pairs, "feature string, importance double")
    ordered = rows.orderBy(F.desc("importance"), "feature")
    return ordered if n is None else ordered.limit(n)


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)
