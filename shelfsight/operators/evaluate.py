"""Evaluation of predictions as queries over a table of (label, prediction, score).

Every report starts from the confusion counts, one row per (label, prediction) pair, so nothing
beyond a partial count per task is shuffled. ROC curve and area start from the counts per distinct
score. Their running totals are split by score range: totals per range first, then the order within
each range, so that no task has to order all scores.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfsight.session import written


def confusion(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by, "label", "prediction").agg(F.count(F.lit(1)).alias("n"))


def confusion_share(df: DataFrame, normalize: str = "true", by: Sequence[str] = ()) -> DataFrame:
    """Confusion counts as shares of the true class, the predicted class, or everything."""
    over = {"true": ["label"], "pred": ["prediction"], "all": []}[normalize]
    total = F.sum("n").over(Window.partitionBy(*by, *over))  # over the few confusion cells
    return confusion(df, by).withColumn("share", F.col("n") / total)


def _ratio(top: Column, bottom: Column) -> Column:
    """A quotient that is 0 where there is nothing to divide by."""
    return F.when(bottom == 0, F.lit(0.0)).otherwise(top / F.when(bottom != 0, bottom))


def per_class(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support of every class seen as label or prediction."""
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(F.lit(0))
    nothing = F.lit(0).cast("bigint")
    sides = F.array(
        F.struct(F.col("label").alias("cls"), F.col("n").alias("actual"), nothing.alias("guessed"), hit.cast("bigint").alias("hit")),
        F.struct(F.col("prediction").alias("cls"), nothing.alias("actual"), F.col("n").alias("guessed"), nothing.alias("hit")),
    )
    counts = (
        confusion(df, by).select(*by, F.inline(sides))
        .groupBy(*by, "cls")
        .agg(F.sum("actual").alias("support"), F.sum("guessed").alias("guessed"), F.sum("hit").alias("hit"))
    )
    scored = counts.withColumns(
        {
            "precision": _ratio(F.col("hit"), F.col("guessed")),
            "recall": _ratio(F.col("hit"), F.col("support")),
            "f1": _ratio(2 * F.col("hit"), F.col("guessed") + F.col("support")),
        }
    )
    return scored.select(*by, F.col("cls").alias("class"), "precision", "recall", "f1", "support", "hit")


def _weighted(metric: str) -> Column:
    return _ratio(F.sum(F.col(metric) * F.col("support")), F.sum("support"))


def overall(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1."""
    return per_class(df, by).groupBy(*by).agg(
        _ratio(F.sum("hit"), F.sum("support")).alias("accuracy"),
        _weighted("f1").alias("f1"),
        _weighted("precision").alias("precision"),
        _weighted("recall").alias("recall"),
    )


def positive_class(df: DataFrame, positive: float = 1, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall and F1 of one class, with overall accuracy."""
    told, true = F.col("prediction") == F.lit(positive), F.col("label") == F.lit(positive)
    counts = df.groupBy(*by).agg(
        F.count_if(told & true).alias("tp"), F.count_if(told).alias("guessed"),
        F.count_if(true).alias("actual"), F.count_if(F.col("label") == F.col("prediction")).alias("right"),
        F.count(F.lit(1)).alias("n"),
    )
    return counts.select(
        *by, _ratio(F.col("right"), F.col("n")).alias("accuracy"),
        _ratio(F.col("tp"), F.col("guessed")).alias("precision"),
        _ratio(F.col("tp"), F.col("actual")).alias("recall"),
        _ratio(2 * F.col("tp"), F.col("guessed") + F.col("actual")).alias("f1"),
    )


def class_report(df: DataFrame, digits: int = 4) -> DataFrame:
    """One row per class, then accuracy, macro and weighted averages."""
    classes = per_class(df)
    metrics = ["precision", "recall", "f1"]
    support = F.sum("support").alias("support")
    by_class = classes.select(F.col("class").cast("string").alias("class"), *metrics, "support")
    accuracy = _ratio(F.sum("hit"), F.sum("support"))
    averages = classes.agg(
        *[F.avg(m).alias(f"macro_{m}") for m in metrics], *[_weighted(m).alias(f"weighted_{m}") for m in metrics],
        accuracy.alias("accuracy"), support,
    ).select(
        F.inline(F.array(
            F.struct(F.lit("accuracy").alias("class"), *[F.col("accuracy").alias(m) for m in metrics], "support"),
            F.struct(F.lit("macro avg").alias("class"), *[F.col(f"macro_{m}").alias(m) for m in metrics], "support"),
            F.struct(F.lit("weighted avg").alias("class"), *[F.col(f"weighted_{m}").alias(m) for m in metrics], "support"),
        ))
    )
    report = by_class.unionByName(averages)
    return report.select("class", *[F.round(m, digits).alias(m) for m in metrics], "support")


def _by_score(df: DataFrame, positive: Column, by: Sequence[str]) -> DataFrame:
    """Counts per distinct score, each with the number of the score range it lies in.

    The input is counted once. Ranges are cut over the counted scores of each group, so a group whose scores lie
    close together is split like any other.
    """
    counts = df.where(F.col("score").isNotNull()).groupBy(*by, F.col("score").cast("double").alias("score")).agg(
        F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg")
    )
    return written(counts.repartitionByRange(*by, "score").withColumn("range", F.spark_partition_id()), "score-ranges")


def _running(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Adds ``tp`` and ``fp`` (counts at or above the score) and the class totals ``p`` and ``q``."""
    ranges = counts.groupBy(*by, "range").agg(
        F.sum("pos").alias("range_pos"), F.sum("neg").alias("range_neg"),
        F.max_by(F.struct("pos", "neg"), "score").alias("top"),
    )
    # One row per group and range from here to the join.
    above = Window.partitionBy(*by).orderBy(F.desc("range"))
    strictly_above = above.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    ranges = ranges.select(
        *by, "range",
        F.coalesce(F.sum("range_pos").over(strictly_above), F.lit(0)).alias("pos_above"),
        F.coalesce(F.sum("range_neg").over(strictly_above), F.lit(0)).alias("neg_above"),
        F.lead("top").over(above).alias("next_range"),
        (F.row_number().over(above) == 1).alias("first_range"),
        F.sum("range_pos").over(whole).alias("p"), F.sum("range_neg").over(whole).alias("q"),
    )
    inside = Window.partitionBy(*by, "range").orderBy(F.desc("score"))
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    # Null-safe, so that both sides keep the same plan and Spark computes the counts once.
    keys = [*by, "range"]
    renamed = ranges.withColumnsRenamed({k: f"_{k}" for k in keys})
    same = reduce(and_, [counts[k].eqNullSafe(renamed[f"_{k}"]) for k in keys])
    return counts.join(renamed, same).select(
        *by, "score", "pos", "neg", "p", "q",
        (F.col("pos_above") + F.sum("pos").over(upto)).alias("tp"),
        (F.col("neg_above") + F.sum("neg").over(upto)).alias("fp"),
        F.coalesce(F.lead(F.struct("pos", "neg")).over(inside), F.col("next_range")).alias("following"),
        (F.col("first_range") & (F.row_number().over(inside) == 1)).alias("is_first"),
    )


def roc_auc(df: DataFrame, positive: float = 1, by: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve: the chance that a positive outscores a negative, ties count half."""
    points = _running(_by_score(df, F.col("label") == F.lit(positive), by), by)
    # Doubles: the pair count outgrows a long at large sizes.
    beaten = F.col("pos").cast("double") * (F.col("q") - F.col("fp") + F.col("neg") / 2)
    pairs = F.max("p").cast("double") * F.max("q")
    return points.groupBy(*by).agg(F.when(pairs > 0, F.sum(beaten) / pairs).alias("roc_auc"))


def roc_auc_ovr(df: DataFrame, classes: Sequence, scores: str = "scores") -> DataFrame:
    """Support-weighted mean of the one-vs-rest areas; ``scores`` holds one score per class, in order."""
    rows = df.select(
        "label",
        F.inline(F.array(*[
            F.struct(F.lit(c).alias("class"), F.col(scores)[i].alias("score")) for i, c in enumerate(classes)
        ])),
    ).withColumn("is_class", (F.col("label") == F.col("class")).cast("int"))
    one_vs_rest = rows.select("class", F.col("is_class").alias("label"), "score")
    areas = roc_auc(one_vs_rest, 1, ["class"])
    support = one_vs_rest.groupBy("class").agg(F.sum("label").alias("support"))
    joined = areas.join(support, "class")
    return joined.agg(_ratio(F.sum(F.col("roc_auc") * F.col("support")), F.sum("support")).alias("roc_auc"))


def roc_curve(df: DataFrame, positive: float = 1, by: Sequence[str] = ()) -> DataFrame:
    """Points (fpr, tpr, threshold), leaving out points on the line between their neighbours."""
    points = _running(_by_score(df, F.col("label") == F.lit(positive), by), by)
    following = F.col("following")
    bend = (following["pos"] != F.col("pos")) | (following["neg"] != F.col("neg"))
    kept = points.where(F.col("is_first") | following.isNull() | bend)
    curve = kept.select(
        *by, _ratio(F.col("fp"), F.col("q")).alias("fpr"), _ratio(F.col("tp"), F.col("p")).alias("tpr"),
        F.col("score").alias("threshold"),
    )
    origin = df.select(*by).distinct() if by else df.sparkSession.range(1)
    return curve.unionByName(
        origin.select(*by, F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"), F.lit(float("inf")).alias("threshold"))
    )


def compare_models(df: DataFrame, digits: int = 4) -> DataFrame:
    """One row per ``model``: accuracy, weighted precision, recall, F1, and area under the curve."""
    metrics = ["accuracy", "precision", "recall", "f1"]
    joined = overall(df, ["model"]).join(roc_auc(df, 1, ["model"]), "model", "left")
    return joined.select("model", *[F.round(m, digits).alias(m) for m in [*metrics, "roc_auc"]])


def metrics_row(df: DataFrame, model_name: str, **params) -> DataFrame:
    """The served metrics of one model as a one-row frame; ``params`` fills further columns."""
    row = overall(df).withColumn("roc_auc", roc_auc(df).scalar())
    return row.withColumns({"model_name": F.lit(model_name), **{k: F.lit(v) for k, v in params.items()}})
