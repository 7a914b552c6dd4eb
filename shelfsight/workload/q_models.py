"""Models, clusters, components (M). Trained models have no SQL twin; tests check them by their properties."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from shelfsight.operators import clusters, evaluate, models, relate
from shelfsight.plans import training
from shelfsight.session import shared_folder
from shelfsight.workload import roles
from shelfsight.workload.registry import query
from shelfsight.workload.roles import sql

LABEL = "is_recommended"
ID = "review_id"


# Boosting rounds of the export query: enough to show that a bundle scores like its model.
EXPORT_ROUNDS = 5


def labelled_reviews(spark, d):
    """Reviews with one id column and a label that follows from rating, price and skin type, with noise."""
    rows = roles.raw_reviews(spark, d, ID)
    good = F.col("rating") * 2 + F.length("skin_type") / 4 + F.col("l_suppkey") % 5 > 9
    given = F.when(F.col("l_orderkey") % 13 != 0, good.cast("double"))
    return rows.withColumn(LABEL, given).select(
        ID, LABEL, "product_id", "author_id", "rating", "helpfulness", "total_neg_feedback_count", "review_text", "skin_tone", "skin_type", "hair_color")


def catalog(spark, d):
    return roles.products(spark, d).select("product_id", "brand_name", "primary_category", "price_usd")


def prepared(spark, d, folder=None):
    return training.prepare(labelled_reviews(spark, d), catalog(spark, d), [ID], LABEL, folder=folder)


def evaluated(name, model, test):
    rows = models.evaluation_rows(model.transform(test), LABEL, name)
    return evaluate.compare_models(rows)


@query("M01_logistic_regression")
def _(spark, d):
    train, test, _ = prepared(spark, d)
    return evaluated("logistic_regression", models.fit(models.logistic_regression(train.count(), LABEL), train), test)


@query("M02_random_forest")
def _(spark, d):
    train, test, _ = prepared(spark, d)
    weighted = models.with_class_weights(train, LABEL)
    return evaluated("random_forest", models.fit(models.random_forest(LABEL, n_estimators=20, max_depth=6, balanced=True), weighted), test)


@query("M03_gradient_boosting")
def _(spark, d):
    train, test, _ = prepared(spark, d)
    return evaluated("gradient_boosting", models.fit(models.gradient_boosting(LABEL, n_estimators=10, subsample=0.8), train), test)


@query("M04_majority_baseline", sql("""
    SELECT label, (SELECT is_recommended FROM reviews GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS prediction, count(*) AS n
    FROM (SELECT is_recommended AS label FROM reviews) GROUP BY label""", "reviews"))
def _(spark, d):
    rows = roles.reviews(spark, d).select(F.col("is_recommended").alias("label"))
    return evaluate.confusion(models.majority_baseline(rows, rows))


@query("M05_cross_validate")
def _(spark, d):
    train, _, _ = prepared(spark, d)
    mean, spread = models.cross_validate(train, models.logistic_regression(train.count(), LABEL), [ID], LABEL)
    return spark.createDataFrame([("logistic_regression", mean, spread)], "model string, mean_f1 double, std_f1 double")


@query("M06_grid_search")
def _(spark, d):
    train, _, _ = prepared(spark, d)
    grid = {"n_estimators": [5, 10], "learning_rate": [0.05, 0.1], "max_depth": [2, 3]}
    return models.grid_search(train, "gradient_boosting", [ID], LABEL, grid=grid)[0]


@query("M07_random_search")
def _(spark, d):
    train, _, _ = prepared(spark, d)
    space = {"n_estimators": [5, 10], "max_depth": [3, 5], "min_samples_leaf": [1, 4], "class_weight": [None, "balanced"]}
    return models.random_search(train, "random_forest", [ID], LABEL, space=space, n_iter=3)[0]


SEARCHES = """
    SELECT 'm' || CAST(l_linenumber AS VARCHAR) AS model, CASE l_tax WHEN 0 THEN 'base' WHEN 0.01 THEN 'grid' ELSE 'random' END AS strategy,
      round(avg(is_recommended), 6) AS mean_score, round(stddev_samp(is_recommended), 6) AS std_score FROM reviews GROUP BY ALL"""


@query("M08_compare_searches", sql("""
    SELECT f.model, strategy, mean_score, std_score, round(mean_score - base, 6) AS delta FROM found f
    JOIN (SELECT model, mean_score AS base FROM found WHERE strategy = 'base') b ON f.model = b.model""", "reviews", found=SEARCHES))
def _(spark, d):
    tax = F.col("l_tax")
    found = roles.reviews(spark, d).groupBy(
        F.concat(F.lit("m"), F.col("l_linenumber").cast("string")).alias("model"),
        F.when(tax == 0, "base").when(tax == 0.01, "grid").otherwise("random").alias("strategy"),
    ).agg(F.round(F.avg(LABEL), 6).alias("mean_score"), F.round(F.stddev_samp(LABEL), 6).alias("std_score"))
    return models.compare_searches(found).withColumn("delta", F.round("delta", 6))


def vectors(spark, d):
    rows = roles.table(spark, d, "embeddings")
    return rows.select("vec_id", "label", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))


@query("M09_kmeans")
def _(spark, d):
    rows = vectors(spark, d)
    model = clusters.fit_kmeans(rows, 3)
    sizes = model.transform(rows).groupBy(F.col("prediction").alias("cluster")).agg(F.count(F.lit(1)).alias("n"))
    return sizes.withColumn("inertia", F.lit(float(model.summary.trainingCost)))


@query("M10_k_sweep")
def _(spark, d):
    return clusters.k_sweep(vectors(spark, d))


@query("M11_silhouette_rows", """
    SELECT i AS vec_id, c AS cluster, round(CASE WHEN own IS NULL THEN 0 ELSE (other - own) / greatest(own, other) END, 6) AS silhouette FROM (
      SELECT i, c, max(m) FILTER (WHERE c = k) AS own, min(m) FILTER (WHERE c <> k) AS other FROM (
        SELECT a.vec_id AS i, a.label AS c, b.label AS k, CASE WHEN a.label = b.label THEN sum(list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[])) / nullif(count(*) - 1, 0)
          ELSE avg(list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[])) END AS m
        FROM embeddings a CROSS JOIN embeddings b GROUP BY 1, 2, 3) GROUP BY i, c)""")
def _(spark, d):
    rows = vectors(spark, d).withColumnRenamed("label", "cluster")
    return clusters.sampled_silhouette_rows(rows, ["vec_id"], rows.count()).withColumn("silhouette", F.round("silhouette", 6))


@query("M11_silhouette_of_all", """
    SELECT i AS vec_id, c AS cluster, round(CASE WHEN own IS NULL THEN 0 ELSE (other - own) / greatest(own, other) END, 6) AS silhouette FROM (
      SELECT i, c, max(m) FILTER (WHERE c = k) AS own, min(m) FILTER (WHERE c <> k) AS other FROM (
        SELECT a.vec_id AS i, a.label AS c, b.label AS k, CASE WHEN a.label = b.label THEN sum(list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) ^ 2) / nullif(count(*) - 1, 0)
          ELSE avg(list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) ^ 2) END AS m
        FROM embeddings a CROSS JOIN embeddings b GROUP BY 1, 2, 3) GROUP BY i, c)""")
def _(spark, d):
    rows = vectors(spark, d).withColumnRenamed("label", "cluster")
    return clusters.silhouette_rows(rows).select("vec_id", "cluster", F.round("silhouette", 6).alias("silhouette"))


@query("M12_project")
def _(spark, d):
    shown, kept = clusters.project(vectors(spark, d))
    return shown.select("vec_id", F.round(F.abs("PC1"), 6).alias("abs_pc1"), F.round(F.abs("PC2"), 6).alias("abs_pc2"), F.lit(round(kept, 6)).alias("kept"))


@query("M13_explained_variance")
def _(spark, d):
    variance = clusters.explained_variance(vectors(spark, d))
    needed = {share: clusters.components_for(variance, share) for share in (0.90, 0.95)}
    return variance.withColumns({f"needed_{round(share * 100)}": F.lit(n) for share, n in needed.items()})


@query("M14_predict")
def _(spark, d):
    """From raw reviews, labelled or not, to both probabilities; the model goes through a file first."""
    train, _, fitted = prepared(spark, d)
    path = f"{shared_folder(spark, 'model')}/whole"
    models.save(training.whole_model(fitted, models.fit(models.logistic_regression(train.count(), LABEL), train)), path)
    raw = labelled_reviews(spark, d).drop(LABEL)
    found = training.predict_reviews(raw, catalog(spark, d), models.load(path), [ID])
    return found.select(ID, "is_recommended", "probability_recommended", "probability_not_recommended", "model")


@query("M15_importances")
def _(spark, d):
    train, _, _ = prepared(spark, d)
    return models.importances(models.fit(models.random_forest(LABEL, n_estimators=10, max_depth=5), train), train)


@query("M16_save_and_load")
def _(spark, d):
    train, test, _ = prepared(spark, d)
    from pyspark.ml import Pipeline

    path = f"{shared_folder(spark, 'model')}/fitted"
    fitted = models.fit(Pipeline(stages=[models.logistic_regression(train.count(), LABEL)]), train)
    models.save(fitted, path)
    both = [("kept", fitted), ("loaded", models.load(path))]
    return relate.union_by_name(evaluated(name, model, test) for name, model in both)


def _part_sizes(df, part):
    return df.groupBy(LABEL).agg(F.count(F.lit(1)).alias("n")).select(F.lit(part).alias("part"), F.col(LABEL).alias("label"), "n")


@query("M17_prepare", sql("""
    SELECT 'test' AS part, label, CAST(target AS BIGINT) AS n FROM targets UNION ALL SELECT 'train', label, CAST(n - target AS BIGINT) FROM targets""",
    "raw_reviews",
    rows_="SELECT CASE WHEN l_orderkey % 13 <> 0 THEN (rating * 2 + length(skin_type) / 4.0::DOUBLE + l_suppkey % 5 > 9)::INT::DOUBLE END AS label FROM raw_reviews",
    sizes="SELECT label, count(*) AS n FROM rows_ WHERE label IS NOT NULL GROUP BY label",
    quotas="SELECT label, n, ceil(0.2::DOUBLE * sum(n) OVER ()) AS wanted, ceil(0.2::DOUBLE * sum(n) OVER ())::DOUBLE * n / sum(n) OVER () AS quota FROM sizes",
    targets="SELECT *, floor(quota) + (row_number() OVER (ORDER BY quota - floor(quota) DESC, label) <= wanted - sum(floor(quota)) OVER ())::INT AS target FROM quotas"))
def _(spark, d):
    folder = shared_folder(spark, "datasets")
    prepared(spark, d, folder)
    return relate.union_by_name(_part_sizes(spark.read.parquet(f"{folder}/y_{part}"), part) for part in ("train", "test"))


@query("S15_save_datasets", sql("""
    SELECT 'preprocessor' AS artifact, 9::BIGINT AS size
    UNION ALL SELECT what || '_test', CAST(sum(target) AS BIGINT) FROM targets, (VALUES ('X'), ('y')) AS w(what) GROUP BY what
    UNION ALL SELECT what || '_train', CAST(sum(n - target) AS BIGINT) FROM targets, (VALUES ('X'), ('y')) AS w(what) GROUP BY what""",
    "raw_reviews",
    rows_="SELECT CASE WHEN l_orderkey % 13 <> 0 THEN (rating * 2 + length(skin_type) / 4.0::DOUBLE + l_suppkey % 5 > 9)::INT::DOUBLE END AS label FROM raw_reviews",
    sizes="SELECT label, count(*) AS n FROM rows_ WHERE label IS NOT NULL GROUP BY label",
    quotas="SELECT label, n, ceil(0.2::DOUBLE * sum(n) OVER ()) AS wanted, ceil(0.2::DOUBLE * sum(n) OVER ())::DOUBLE * n / sum(n) OVER () AS quota FROM sizes",
    targets="SELECT *, floor(quota) + (row_number() OVER (ORDER BY quota - floor(quota) DESC, label) <= wanted - sum(floor(quota)) OVER ())::INT AS target FROM quotas"))
def _(spark, d):
    from pyspark.ml import PipelineModel

    folder = shared_folder(spark, "datasets")
    prepared(spark, d, folder)
    again = PipelineModel.load(f"{folder}/preprocessor")
    rows = [("preprocessor", len(again.stages))]
    rows += [(f"{what}_{part}", spark.read.parquet(f"{folder}/{what}_{part}").count()) for what in "Xy" for part in ("train", "test")]
    return spark.createDataFrame(rows, "artifact string, size long")


@query("M18_export_model")
def _(spark, d):
    """The exported bundle scores raw reviews like the model that was exported."""
    train, test, fitted = prepared(spark, d)
    model = models.fit(models.gradient_boosting(LABEL, n_estimators=EXPORT_ROUNDS), train)
    whole = training.whole_model(fitted, model)
    paths = training.export_model(
        shared_folder(spark, "export"), "best", whole, model.transform(test), LABEL, {"n_estimators": EXPORT_ROUNDS})
    raw = labelled_reviews(spark, d)
    again = training.predict_reviews(raw.drop(LABEL), catalog(spark, d), models.load(paths["model"]), [ID])
    both = model.transform(test).select(ID, vector_to_array("probability")[1].alias("kept")).join(again, ID)
    gap = both.agg(F.round(F.max(F.abs(F.col("kept") - F.col("probability_recommended"))), 9).alias("largest_gap"))
    return spark.read.parquet(paths["metrics"]).withColumn("largest_gap", gap.scalar())


# Data whose answer SQL knows ------------------------------------------------------------------------


def one_split(spark, d):
    """Line items whose label follows from the line number alone, beside a column that says nothing."""
    line = roles.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    return line.withColumns({
        "label": (F.col("l_linenumber") >= 4).cast("double"),
        "features": array_to_vector(F.array(F.col("l_linenumber").cast("double"), (F.col("l_suppkey") % 3).cast("double"))),
    })


LINES = "SELECT (l_linenumber >= 4)::INT::DOUBLE AS label, count(*) AS n FROM lineitem GROUP BY 1"


@query("M02_one_split", f"SELECT label, label AS prediction, n FROM ({LINES})")
def _(spark, d):
    rows = one_split(spark, d)
    model = models.fit(models.random_forest(n_estimators=5, max_depth=3, max_features=None), rows)
    return evaluate.confusion(model.transform(rows).select("label", "prediction"))


@query("M03_one_split", f"SELECT label, label AS prediction, n FROM ({LINES})")
def _(spark, d):
    rows = one_split(spark, d)
    return evaluate.confusion(models.fit(models.gradient_boosting(n_estimators=3), rows).transform(rows).select("label", "prediction"))


@query("M01_one_split", f"SELECT label, label AS prediction, n FROM ({LINES})")
def _(spark, d):
    rows = one_split(spark, d)
    model = models.fit(models.logistic_regression(rows.count(), C=1e6), rows)
    return evaluate.confusion(model.transform(rows).select("label", "prediction"))


@query("M05_one_split", "SELECT 1.0 AS mean_f1, 0.0 AS std_f1")
def _(spark, d):
    rows = one_split(spark, d)
    scores = models.cross_validate(rows, models.gradient_boosting(n_estimators=2), ["l_orderkey", "l_linenumber"])
    return spark.createDataFrame([scores], "mean_f1 double, std_f1 double")


@query("M06_one_split", """
    SELECT 'gradient_boosting' AS model, '{"learning_rate": ' || rate || ', "n_estimators": ' || rounds || '}' AS params, 1.0 AS mean_score, 0.0 AS std_score
    FROM (VALUES ('0.05'), ('0.1')) AS r(rate), (VALUES (1), (2), (4)) AS n(rounds)""")
def _(spark, d):
    rows = one_split(spark, d)
    grid = {"n_estimators": [1, 2, 4], "learning_rate": [0.05, 0.1]}
    return models.grid_search(rows, "gradient_boosting", ["l_orderkey", "l_linenumber"], grid=grid)[0]


@query("M15_one_split", "SELECT 'line' AS feature, 1.0 AS importance UNION ALL SELECT 'noise', 0.0")
def _(spark, d):
    from pyspark.ml.feature import VectorAssembler

    rows = one_split(spark, d).select("label", F.col("l_linenumber").cast("double").alias("line"), (F.col("l_suppkey") % 3).cast("double").alias("noise"))
    ready = VectorAssembler(inputCols=["line", "noise"], outputCol="features").transform(rows)
    return models.importances(models.fit(models.random_forest(n_estimators=5, max_depth=3, max_features=None), ready), ready)


@query("M14_one_split", f"SELECT label::INT AS is_recommended, label AS probability_recommended, 1 - label AS probability_not_recommended, n FROM ({LINES})")
def _(spark, d):
    rows = one_split(spark, d)
    model = models.fit(models.random_forest(n_estimators=5, max_depth=3, max_features=None), rows)
    shown = ["is_recommended", "probability_recommended", "probability_not_recommended"]
    return models.predict(rows, model).groupBy(*shown).agg(F.count(F.lit(1)).alias("n"))


@query("M16_one_split", f"SELECT part, label, label AS prediction, n FROM ({LINES}), (VALUES ('kept'), ('loaded')) AS p(part)")
def _(spark, d):
    from pyspark.ml import Pipeline

    rows = one_split(spark, d)
    path = f"{shared_folder(spark, 'model')}/tree"
    fitted = models.fit(Pipeline(stages=[models.random_forest(n_estimators=3, max_depth=2, max_features=None)]), rows)
    models.save(fitted, path)
    return relate.union_by_name(
        evaluate.confusion(model.transform(rows).select("label", "prediction")).withColumn("part", F.lit(part))
        for part, model in (("kept", fitted), ("loaded", models.load(path))))


@query("M09_two_groups", """
    SELECT count(*) AS n, round((SELECT sum(v) FROM (SELECT var_pop(l_linenumber) * count(*) AS v FROM lineitem GROUP BY l_returnflag = 'R')), 6) AS inertia
    FROM lineitem GROUP BY l_returnflag = 'R'""")
def _(spark, d):
    far = F.when(F.col("l_returnflag") == "R", 1000.0).otherwise(0.0)
    rows = roles.table(spark, d, "lineitem").select(array_to_vector(F.array(F.col("l_linenumber") + far)).alias("features"))
    model = clusters.fit_kmeans(rows, 2, tries=3)
    sizes = model.transform(rows).groupBy("prediction").agg(F.count(F.lit(1)).alias("n")).drop("prediction")
    return sizes.withColumn("inertia", F.lit(round(float(model.summary.trainingCost), 6)))


@query("M10_two_groups", """
    SELECT 2 AS k, round((SELECT sum(v) FROM (SELECT var_pop(l_linenumber) * count(*) AS v FROM lineitem GROUP BY l_returnflag = 'R')), 4) AS inertia, true AS is_best""")
def _(spark, d):
    """Of all k, the two groups that lie far apart are the best."""
    far = F.when(F.col("l_returnflag") == "R", 1000.0).otherwise(0.0)
    rows = roles.table(spark, d, "lineitem").select(array_to_vector(F.array(F.col("l_linenumber") + far)).alias("features"))
    found = clusters.k_sweep(rows, range(2, 4))
    return found.where("is_best").select("k", F.round("inertia", 4).alias("inertia"), "is_best")


PLANE = """
    SELECT *, (a + c + sqrt((a - c) ^ 2 + 4 * b ^ 2)) / 2 AS high, (a + c - sqrt((a - c) ^ 2 + 4 * b ^ 2)) / 2 AS low, 0.5 * atan2(2 * b, a - c) AS turn FROM (
      SELECT var_pop(x) AS a, var_pop(y) AS c, covar_pop(x, y) AS b, avg(x) AS mx, avg(y) AS my
      FROM (SELECT l_quantity::DOUBLE AS x, (l_quantity + l_linenumber * 5)::DOUBLE AS y FROM lineitem))"""


def plane(spark, d):
    quantity, number = F.col("l_quantity").cast("double"), F.col("l_linenumber")
    return roles.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", array_to_vector(F.array(quantity, quantity + number * 5.0)).alias("features"))


@query("M12_two_columns", f"""
    SELECT l_orderkey, l_linenumber, round(abs((l_quantity - mx) * cos(turn) + (l_quantity + l_linenumber * 5 - my) * sin(turn)), 6) AS abs_pc1, round(high / (high + low), 6) AS kept
    FROM lineitem, ({PLANE})""")
def _(spark, d):
    shown, kept = clusters.project(plane(spark, d), k=1)
    return shown.select("l_orderkey", "l_linenumber", F.round(F.abs("PC1"), 6).alias("abs_pc1"), F.lit(round(kept, 6)).alias("kept"))


@query("M13_two_columns", f"""
    SELECT 1 AS component, round(high / (high + low), 9) AS share, round(high / (high + low), 9) AS cumulative FROM ({PLANE})
    UNION ALL SELECT 2, round(low / (high + low), 9), 1.0 FROM ({PLANE})""")
def _(spark, d):
    found = clusters.explained_variance(plane(spark, d))
    return found.select("component", F.round("share", 9).alias("share"), F.round("cumulative", 9).alias("cumulative"))
