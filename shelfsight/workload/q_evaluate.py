"""Evaluation (X)."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfsight.operators import evaluate, reports
from shelfsight.sources.tables import Warehouse, append_metrics
from shelfsight.session import shared_folder
from shelfsight.workload import roles
from shelfsight.workload.q_reports import rounded
from shelfsight.workload.registry import query
from shelfsight.workload.roles import sql


def first_model(spark, d):
    return roles.scores(spark, d).where("model = 'first'").drop("model")


PER_CLASS = """
    SELECT cls AS "class", CASE WHEN guessed = 0 THEN 0 ELSE hit / guessed::DOUBLE END AS precision, CASE WHEN support = 0 THEN 0 ELSE hit / support::DOUBLE END AS recall,
      CASE WHEN guessed + support = 0 THEN 0 ELSE 2.0 * hit / (guessed + support)::DOUBLE END AS f1, support, hit, model
    FROM (SELECT model, cls, count(*) FILTER (WHERE label = cls) AS support, count(*) FILTER (WHERE prediction = cls) AS guessed,
            count(*) FILTER (WHERE label = cls AND prediction = cls) AS hit
          FROM scores CROSS JOIN (VALUES (0.0::DOUBLE), (1.0::DOUBLE)) v(cls) GROUP BY model, cls)"""


@query("X01_confusion", sql("SELECT model, label, prediction, count(*) AS n FROM scores GROUP BY ALL", "scores"))
def _(spark, d):
    return evaluate.confusion(roles.scores(spark, d), ["model"])


@query("X01_confusion_share", sql("""
    SELECT label, prediction, n, round(n / (sum(n) OVER (PARTITION BY label))::DOUBLE, 9) AS share
    FROM (SELECT label, prediction, count(*) AS n FROM scores WHERE model = 'first' GROUP BY ALL)""", "scores"))
def _(spark, d):
    return rounded(evaluate.confusion_share(first_model(spark, d)), 9, "share")


WEIGHTED = ", ".join(f"sum({m} * support) / sum(support)::DOUBLE AS {m}" for m in ("precision", "recall", "f1"))


@query("X02_overall", sql("SELECT model, round(accuracy, 9) AS accuracy, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1 FROM (SELECT model, sum(hit) / sum(support)::DOUBLE AS accuracy, " + WEIGHTED + " FROM per_class GROUP BY model)", "scores", per_class=PER_CLASS))
def _(spark, d):
    return rounded(evaluate.overall(roles.scores(spark, d), ["model"]), 9)


@query("X03_positive_class", sql("""
    SELECT model, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1,
      (SELECT round(avg((label = prediction)::INT), 9) FROM scores s WHERE s.model = p.model) AS accuracy FROM per_class p WHERE "class" = 1""", "scores", per_class=PER_CLASS))
def _(spark, d):
    return rounded(evaluate.positive_class(roles.scores(spark, d), 1, ["model"]), 9)


@query("X04_class_report", sql("""
    SELECT CASE WHEN "class" = 1 THEN '1.0' ELSE '0.0' END AS "class", round(precision, 4) AS precision, round(recall, 4) AS recall, round(f1, 4) AS f1, support FROM one
    UNION ALL SELECT 'accuracy', a, a, a, s FROM (SELECT round(sum(hit) / sum(support)::DOUBLE, 4) AS a, CAST(sum(support) AS BIGINT) AS s FROM one)
    UNION ALL SELECT 'macro avg', round(avg(precision), 4), round(avg(recall), 4), round(avg(f1), 4), CAST(sum(support) AS BIGINT) FROM one
    UNION ALL SELECT 'weighted avg', round(precision, 4), round(recall, 4), round(f1, 4), CAST(s AS BIGINT) FROM (SELECT """ + WEIGHTED + """, sum(support) AS s FROM one)""",
    "scores", per_class=PER_CLASS, one="SELECT * FROM per_class WHERE model = 'first'"))
def _(spark, d):
    return evaluate.class_report(first_model(spark, d))


AUC = """
    SELECT model, (sum(CASE WHEN label = 1 THEN r END) - count(*) FILTER (WHERE label = 1) * (count(*) FILTER (WHERE label = 1) + 1) / 2.0::DOUBLE)
      / (count(*) FILTER (WHERE label = 1)::DOUBLE * count(*) FILTER (WHERE label <> 1)) AS roc_auc
    FROM (SELECT model, label, rank() OVER (PARTITION BY model ORDER BY score) + (count(*) OVER (PARTITION BY model, score) - 1) / 2.0::DOUBLE AS r FROM scores) GROUP BY model"""


@query("X05_roc_auc", sql("SELECT model, round(roc_auc, 9) AS roc_auc FROM areas", "scores", areas=AUC))
def _(spark, d):
    return rounded(evaluate.roc_auc(roles.scores(spark, d), 1, ["model"]), 9)


THREE = """
    SELECT l_linenumber % 3 AS label, (l_partkey % 17 + CASE WHEN l_linenumber % 3 = 0 THEN 4 ELSE 0 END) / 30.0::DOUBLE AS s0,
      (l_partkey % 13 + CASE WHEN l_linenumber % 3 = 1 THEN 3 ELSE 0 END) / 30.0::DOUBLE AS s1, (l_suppkey % 11 + CASE WHEN l_linenumber % 3 = 2 THEN 2 ELSE 0 END) / 30.0::DOUBLE AS s2 FROM lineitem"""


@query("X05_roc_auc_ovr", sql("""
    SELECT round(sum(auc * p) / sum(p), 9) AS roc_auc FROM (
      SELECT c, count(*) FILTER (WHERE hit) AS p, (sum(CASE WHEN hit THEN r END) - count(*) FILTER (WHERE hit) * (count(*) FILTER (WHERE hit) + 1) / 2.0::DOUBLE)
        / (count(*) FILTER (WHERE hit)::DOUBLE * count(*) FILTER (WHERE NOT hit)) AS auc
      FROM (SELECT c, label = c AS hit, rank() OVER (PARTITION BY c ORDER BY s) + (count(*) OVER (PARTITION BY c, s) - 1) / 2.0::DOUBLE AS r
            FROM (SELECT 0 AS c, label, s0 AS s FROM three UNION ALL SELECT 1, label, s1 FROM three UNION ALL SELECT 2, label, s2 FROM three)) GROUP BY c)""", three=THREE))
def _(spark, d):
    line = roles.table(spark, d, "lineitem")
    label = F.col("l_linenumber") % 3
    keys = [("l_partkey", 17, 4), ("l_partkey", 13, 3), ("l_suppkey", 11, 2)]
    each = [(F.col(k) % m + F.when(label == i, extra).otherwise(0)) / 30.0 for i, (k, m, extra) in enumerate(keys)]
    return rounded(evaluate.roc_auc_ovr(line.select(label.alias("label"), F.array(*each).alias("scores")), [0, 1, 2]), 9)


ROC = """
    SELECT model, round(fp / q::DOUBLE, 9) AS fpr, round(tp / p::DOUBLE, 9) AS tpr, round(score, 9) AS threshold FROM (
      SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER (PARTITION BY model) AS p, sum(neg) OVER (PARTITION BY model) AS q,
        row_number() OVER w AS i, lead(pos) OVER w AS next_pos, lead(neg) OVER w AS next_neg
      FROM (SELECT model, score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label <> 1) AS neg FROM scores GROUP BY model, score)
      WINDOW w AS (PARTITION BY model ORDER BY score DESC))
    WHERE i = 1 OR next_pos IS NULL OR next_pos <> pos OR next_neg <> neg
    UNION ALL SELECT DISTINCT model, 0.0::DOUBLE, 0.0::DOUBLE, 'infinity'::DOUBLE FROM scores"""


@query("X06_roc_curve", sql(ROC, "scores"))
def _(spark, d):
    return rounded(evaluate.roc_curve(roles.scores(spark, d), 1, ["model"]), 9)


COMPARE = "SELECT model, round(accuracy, 4) AS accuracy, round(precision, 4) AS precision, round(recall, 4) AS recall, round(f1, 4) AS f1, round(roc_auc, 4) AS roc_auc FROM (SELECT model, sum(hit) / sum(support)::DOUBLE AS accuracy, " + WEIGHTED + " FROM per_class GROUP BY model) JOIN areas USING (model)"


@query("X07_compare_models", sql(COMPARE, "scores", per_class=PER_CLASS, areas=AUC))
def _(spark, d):
    return evaluate.compare_models(roles.scores(spark, d))


@query("X08_stored_metrics", sql("SELECT 'first' AS model_name, 100 AS n_estimators, * EXCLUDE (model) FROM (" + COMPARE + ") WHERE model = 'first'", "scores", per_class=PER_CLASS, areas=AUC))
def _(spark, d):
    warehouse = Warehouse(spark, shared_folder(spark, "metrics"))
    append_metrics(warehouse, evaluate.metrics_row(first_model(spark, d), "first", n_estimators=100))
    kept = warehouse.read("model_metrics").select("model_name", "n_estimators", "accuracy", "precision", "recall", "f1", "roc_auc")
    return rounded(kept, 4)


@query("X09_clusters_against_label", sql("""
    SELECT cluster, count(label) AS total, CAST(sum(label) AS BIGINT) AS recommended, round(sum(label) * 100.0::DOUBLE / count(label), 2) AS pct_recommended,
      round(count(label) * 100.0::DOUBLE / (SELECT count(label) FROM clustered), 2) AS pct_of_total FROM clustered GROUP BY cluster""",
    clustered="SELECT vec_id % 4 AS cluster, CASE WHEN label % 2 = 0 THEN 1 ELSE 0 END AS label FROM embeddings"))
def _(spark, d):
    rows = roles.table(spark, d, "embeddings").select((F.col("vec_id") % 4).alias("cluster"), F.when(F.col("label") % 2 == 0, 1).otherwise(0).alias("label"))
    return reports.cluster_profile(rows, "cluster", "label")
