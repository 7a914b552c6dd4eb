import json

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from shelfsight.operators import clusters, features, models, profile
from shelfsight.plans import training


@pytest.fixture(scope="module")
def train(spark):
    return spark.sql("""
        select * from values (1, 1.0D, 'a', null, 5L), (2, 3.0D, 'b', null, 5L), (3, null, 'b', 'z', 5L), (4, 100.0D, 'a', null, 5L)
        as t(id, x, c, gap, flat)""")


def test_impute_learns_from_training_rows_only(spark, train):
    fitted = features.Impute().fit(train)
    later = spark.sql("select 9 id, cast(null as double) x, cast(null as string) c, cast(null as string) gap, 1L flat")
    row = fitted.transform(later).first()
    assert (row["x"], row["c"], row["gap"]) == (3.0, "a", "z")  # median; smallest of tied values
    assert fitted.learned == features.Impute().fit(train).learned
    assert fitted.simple_columns == [] and set(fitted.complex_columns) == {"x", "gap"}


def test_impute_overrides_and_empty_text(spark):
    df = spark.sql("select cast(null as double) x, cast(null as string) c union all select 4.0D, null")
    row = features.Impute(overrides=json.dumps({"x": 0})).fit(df).transform(df).where("x = 0").first()
    assert row["c"] == "Unknown"


def test_capping(train):
    fitted = features.Cap(exclude=["id", "flat"]).fit(train)
    assert fitted.learned == {"x": [2.0 - 1.5 * 49.5, 51.5 + 1.5 * 49.5]}
    assert fitted.transform(train).agg(F.max("x")).first()[0] == 100.0
    outer = features.Cap(method="quantile", lower=0.25, upper=0.75, exclude=["id", "flat"]).fit(train).transform(train)
    assert sorted(r["x"] for r in outer.collect() if r["x"] is not None) == [2.0, 3.0, 51.5]


@pytest.mark.parametrize("bad", [{"lower": 0.0}, {"upper": 1.0}, {"lower": 0.6, "upper": 0.5}, {"method": "other"}])
def test_capping_rejects(bad):
    with pytest.raises(ValueError):
        features.Cap(**bad)


def test_dropping(train):
    assert "gap" not in features.DropSparse(threshold=0.7).fit(train).transform(train).columns
    assert "gap" in features.DropSparse(threshold=0.75).fit(train).transform(train).columns
    assert "flat" not in features.DropConstant().fit(train).transform(train).columns
    one = train.limit(1)
    assert "flat" in features.DropConstant().fit(one).transform(one).columns
    with_empty = train.withColumn("none", F.lit(None).cast("string"))
    assert features.DropEmpty().fit(with_empty).transform(with_empty).columns == train.columns
    with pytest.raises(ValueError):
        features.DropSparse(threshold=1.5)


def test_scaling_uses_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 7.0), (3.0, 7.0)], "x double, flat double")
    assert [tuple(r) for r in features.Scale().fit(df).transform(df).collect()] == [(-1.0, 0.0), (1.0, 0.0)]


def test_unseen_and_null_categories_are_zeros(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",)], "c string")
    fitted = Pipeline(stages=features.one_hot_stages(["c"])).fit(df)
    new = spark.createDataFrame([("a",), ("b",), ("zzz",), (None,)], "c string")
    assert [r[0] for r in fitted.transform(new).select(vector_to_array("c_hot")).collect()] == [[1, 0], [0, 1], [0, 0], [0, 0]]


def test_frequent_categories(spark):
    df = spark.createDataFrame([(c,) for c in "aaaabbbccdde"], "c string")
    fitted = features.KeepFrequent(maxCategories=3).fit(df)
    new = spark.createDataFrame([("a",), ("b",), ("c",), ("e",), ("never",), (None,)], "c string")
    assert [r["c"] for r in fitted.transform(new).collect()] == ["a", "b", "infrequent", "infrequent", "infrequent", None]
    assert features.KeepFrequent(maxCategories=5).fit(df).transform(new).collect()[4]["c"] is None
    assert features.KeepFrequent(maxCategories=5).fit(df).transform(df).collect() == df.collect()


@pytest.mark.parametrize("rare", [5, 12_000])
def test_unseen_values_are_alike_at_every_size(spark, rare):
    df = spark.range(rare).selectExpr("concat('r', id) as c").unionAll(spark.range(50).selectExpr("'often' as c"))
    fitted = features.KeepFrequent(maxCategories=3).fit(df)
    new = spark.createDataFrame([("often",), ("never",), ("r0",), (None,)], "c string")
    assert [r["c"] for r in fitted.transform(new).collect()] == ["often", "infrequent", "infrequent", None]


def test_long_ids_survive_imputation(spark):
    big = 9007199254740993
    df = spark.createDataFrame([(big, 1.5, 1), (None, None, 4), (big, 2.5, None), (big + 2, 3.5, 3)], "id long, x double, n int")
    filled = features.Impute().fit(df).transform(df)
    assert dict(filled.dtypes) == {"id": "bigint", "x": "double", "n": "int"}
    assert [r["id"] for r in filled.collect()][0] == big and [r["n"] for r in filled.collect()] == [1, 4, 3, 3]


def test_preprocessor_round_trip(spark, tmp_path):
    df = spark.range(200).selectExpr(
        "id", "double(id % 2) y", "case when id % 7 = 0 then null else double(id % 50) end x",
        "case when id % 9 = 0 then ' Unknown ' else concat('t', id % 3) end t", "case when id = 3 then 'q' end sparse")
    fitted = features.preprocessor(df, "y", ["id"]).fit(df)
    ready = fitted.transform(df)
    names = features.feature_names(ready)
    assert names == ["x", "t_hot_t0", "t_hot_t1", "t_hot_t2"]
    models.save(fitted, str(tmp_path / "p"))
    again = models.load(str(tmp_path / "p")).transform(df)
    assert [r["features"] for r in ready.orderBy("id").collect()] == [r["features"] for r in again.orderBy("id").collect()]


def learnable(spark, n=600):
    return spark.range(n).selectExpr("id", "double(id * 7919 % 101 > 40) label", "double(id * 7919 % 101) a", "double(id % 13) b").select(
        "id", "label", array_to_vector(F.array("a", "b")).alias("features"))


@pytest.mark.parametrize("make", [
    lambda n: models.logistic_regression(n, max_iter=50), lambda n: models.random_forest(n_estimators=5, max_depth=4),
    lambda n: models.gradient_boosting(n_estimators=5)])
def test_classifiers_learn(spark, make):
    df = learnable(spark)
    scored = models.predict(df, make(df.count()).fit(df))
    right = scored.agg(F.avg((F.col("is_recommended") == F.col("label")).cast("int"))).first()[0]
    assert right > 0.95
    gap = F.abs(F.col("probability_recommended") + F.col("probability_not_recommended") - 1)
    assert scored.agg(F.max(gap)).first()[0] < 1e-9 and scored.count() == df.count()


def test_balanced_weights(spark):
    df = spark.createDataFrame([(1.0,)] * 6 + [(0.0,)] * 2, "label double")
    weights = {r["label"]: r[models.WEIGHT] for r in models.with_class_weights(df).distinct().collect()}
    assert weights == {1.0: pytest.approx(8 / 12), 0.0: pytest.approx(2.0)}


def test_majority(spark):
    df = spark.createDataFrame([(1.0,), (0.0,), (1.0,), (0.0,), (None,), (None,), (None,)], "label double")
    assert models.majority_label(df) == 0.0


def test_search_spaces():
    assert {name: len(models.combinations_of(grid)) for name, grid in models.BOOSTING_GRIDS.items()} == {"large": 16, "medium": 8, "small": 54}
    with pytest.raises(ValueError):
        models.random_forest(max_depth=31)
    drawn = models.random_combinations(models.FOREST_SPACE, 20)
    assert len(drawn) == 20 and drawn == models.random_combinations(models.FOREST_SPACE, 20)
    assert len({json.dumps(c, sort_keys=True) for c in drawn}) == 20


def test_search_and_cross_validation(spark):
    df = learnable(spark, 300)
    results, best = models.grid_search(df, "random_forest", ["id"], grid={"n_estimators": [2, 4], "class_weight": [None, "balanced"]}, folds=2)
    rows = results.collect()
    assert len(rows) == 4 and rows[0]["mean_score"] >= rows[-1]["mean_score"] and best.getNumTrees in (2, 4)
    mean, spread = models.cross_validate(df, models.random_forest(n_estimators=3, max_depth=3), ["id"], folds=3)
    assert 0.8 < mean <= 1.0 and spread >= 0


def test_importances_are_named(spark):
    df = spark.range(300).selectExpr("id", "double(id % 10 > 4) y", "double(id % 10) x", "double(id % 3) noise")
    ready = features.preprocessor(df, "y", ["id"]).fit(df).transform(df)
    top = models.importances(models.random_forest("y", n_estimators=5, max_depth=3).fit(ready), ready).first()
    assert top["feature"] == "x"


def blobs(spark):
    return spark.range(90).selectExpr("id", "double(id % 3) * 20 + (id % 7) / 10 as a", "double(id % 3) * -30 + (id % 5) / 10 as b").select(
        "id", (F.col("id") % 3).cast("int").alias("cluster"), array_to_vector(F.array("a", "b")).alias("features"))


def test_k_sweep_finds_the_blobs(spark):
    found = clusters.k_sweep(blobs(spark), range(2, 5))
    assert found.where("is_best").first()["k"] == 3
    costs = [r["inertia"] for r in found.orderBy("k").collect()]
    assert costs == sorted(costs, reverse=True)
    assert clusters.fit_kmeans(blobs(spark), 3, tries=3).summary.trainingCost == pytest.approx(costs[1])


def test_silhouette_by_hand(spark):
    import numpy as np

    rows = [(i, int(i % 4 == 0) + int(i == 5), [float(i * i % 17), float(i % 5)]) for i in range(30)]
    df = spark.createDataFrame(rows, "id long, cluster int, features array<double>")
    found = {r["id"]: r["silhouette"] for r in clusters.sampled_silhouette_rows(df, ["id"], 100).collect()}
    for i, c, x in rows:
        gaps = {}
        for j, k, y in rows:
            if j != i:
                gaps.setdefault(k, []).append(float(np.linalg.norm(np.subtract(x, y))))
        if c not in gaps:
            assert found[i] == 0
            continue
        a, b = np.mean(gaps[c]), min(np.mean(v) for k, v in gaps.items() if k != c)
        assert found[i] == pytest.approx((b - a) / max(a, b), abs=1e-6)
    assert clusters.sampled_silhouette_rows(df, ["id"], 12).count() == 12


def test_silhouette_of_all_rows(spark):
    from pyspark.ml.evaluation import ClusteringEvaluator

    df = blobs(spark)
    assigned = clusters.fit_kmeans(df, 3, tries=2).transform(df)
    library = ClusteringEvaluator(featuresCol="features", predictionCol="prediction").evaluate(assigned)
    assert clusters.silhouette(assigned, cluster="prediction") == pytest.approx(library)
    assert clusters.silhouette(assigned.withColumn("cluster", F.lit(0))) == 0


def test_components(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 4)) * [5, 3, 1, 0.1] + [100, 0, -50, 3]
    df = spark.createDataFrame([(r.tolist(),) for r in x], "v array<double>").select(array_to_vector("v").alias("features"))
    eigen = np.sort(np.linalg.eigvalsh(np.cov(x.T)))[::-1]
    variance = clusters.explained_variance(df)
    assert [r["share"] for r in variance.orderBy("component").collect()] == pytest.approx(list(eigen / eigen.sum()))
    assert clusters.components_for(variance, 0.90) == int(np.searchsorted(np.cumsum(eigen / eigen.sum()), 0.90)) + 1
    shown, kept = clusters.project(df)
    assert kept == pytest.approx(eigen[:2].sum() / eigen.sum())
    assert abs(shown.agg(F.avg("PC1")).first()[0]) < 1e-9


def test_training_plan(spark, raw_reviews, tmp_path):
    reviews = spark.range(400).selectExpr(
        "concat('r', id) review_id", "concat('P', id % 4) product_id", "double(id % 5 + 1) rating",
        "case when id % 11 <> 0 then double(id % 5 > 1) end is_recommended", "'text' review_text", "concat('s', id % 2) skin_type")
    products = spark.range(4).selectExpr("concat('P', id) product_id", "double(id * 10) price_usd", "double(id) rating")
    train, test, fitted = training.prepare(reviews, products, ["review_id"], folder=str(tmp_path / "sets"))
    total = reviews.where("is_recommended is not null").count()
    assert train.count() + test.count() == total and test.count() == -(-total // 5)
    names = features.feature_names(train)
    assert "rating_x" in names and "price_usd" in names and not any("review_text" in n for n in names)
    pipeline = Pipeline(stages=[models.random_forest("is_recommended", n_estimators=3, max_depth=4)]).fit(train)
    paths = training.export_model(str(tmp_path / "out"), "best", pipeline, pipeline.transform(test), "is_recommended")
    assert spark.read.parquet(paths["metrics"]).first()["accuracy"] == 1.0
    assert isinstance(PipelineModel.load(paths["model"]), PipelineModel)
    assert spark.read.parquet(paths["report"]).count() == 5
    assert isinstance(fitted, PipelineModel)


def test_profiles(spark):
    df = spark.sql("select * from values (1D, 'a', null), (2D, 'b', null), (3D, 'b', 'x'), (null, 'a', null), (null, 'a', null) as t(x, c, s)")
    row = profile.describe_numeric(df, ["x"]).first()
    assert (row["count"], row["mean"], row["std"], row["q25"], row["max"]) == (3, 2.0, 1.0, 1.5, 3.0)
    assert {r["column"]: r["missing"] for r in profile.missing_summary(df).collect()} == {"s": 4, "x": 2, "c": 0}
    text = {r["column"]: r for r in profile.describe_text(df).collect()}
    assert (text["c"]["unique"], text["c"]["top"], text["c"]["freq"]) == (2, "a", 3)
    assert profile.duplicate_rows(df).first()["duplicates"] == 1
    assert {r["column"]: r["distinct_values"] for r in profile.cardinality(df, exact=False).collect()} == {"c": 2, "s": 1}
    mixed = spark.createDataFrame([("1",), ("2024-01-02",), ("x",)], "v string")
    assert profile.mixed_types(mixed).first()["mixed"] is True
    pairs = spark.createDataFrame([(1.0, 2.0), (2.0, 4.1), (3.0, None), (None, 1.0), (4.0, 7.9)], "a double, b double")
    r = profile.correlations(pairs).where("a = 'a' and b = 'b'").first()["r"]
    assert r == pytest.approx(0.99994, abs=1e-3)


def noisy(spark, n=400):
    from pyspark.ml.functions import array_to_vector

    x, y = F.pmod(F.xxhash64("id"), F.lit(97)) / 97, F.pmod(F.xxhash64("id", F.lit(1)), F.lit(89)) / 89
    good = (x + y > 1) != (F.pmod(F.xxhash64("id", F.lit(2)), F.lit(10)) == 0)
    return spark.range(n).select("id", good.cast("double").alias("label"), array_to_vector(F.array(x, y, x * y)).alias("features")).cache()


def counted(model, df):
    row = model.transform(df).agg(*[F.count_if((F.col("prediction") == p) & (F.col("label") == y)).alias(n) for n, p, y in (("tp", 1, 1), ("fp", 1, 0), ("fn", 0, 1), ("tn", 0, 0))]).first()
    return row.asDict()


def test_stages_are_separate_fits(spark):
    """A boosted model cut to its first trees predicts like a model of that many rounds; so does a search over rounds."""
    df = noisy(spark)
    make = lambda n: models.gradient_boosting(n_estimators=n, learning_rate=0.3, max_depth=2, subsample=0.8)
    found = models.staged_confusion(models.fit(make(7), df), df, [1, 3, 7])
    assert found == {n: counted(models.fit(make(n), df), df) for n in (1, 3, 7)}
    assert len({tuple(c.values()) for c in found.values()}) > 1
    fits, real = [], models.fit
    try:
        models.fit = lambda estimator, rows: fits.append(estimator.getMaxIter()) or real(estimator, rows)
        grid = {"n_estimators": [1, 2, 4], "learning_rate": [0.3, 0.6]}
        results, best = models.grid_search(df, "gradient_boosting", ["id"], grid=grid, folds=2)
    finally:
        models.fit = real
    assert sorted(fits[:-1]) == [4] * 4 and best.getNumTrees == fits[-1]
    rows = {r["params"]: (r["mean_score"], r["std_score"]) for r in results.collect()}
    assert len(rows) == 6
    for rounds in grid["n_estimators"]:
        single, _ = models.grid_search(df, "gradient_boosting", ["id"], grid={"n_estimators": [rounds], "learning_rate": [0.6]}, folds=2)
        one = single.first()
        assert rows[one["params"]] == pytest.approx((one["mean_score"], one["std_score"]))


def test_models_after_an_observed_write(spark, tmp_path):
    """Models hold on to nothing of the session, so that they work after the session has observed a write."""
    from pyspark.ml import Pipeline
    from pyspark.sql import Observation

    seen = Observation("rows")
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(str(tmp_path / "t"))
    assert seen.get["n"] == 3
    df = noisy(spark)
    for estimator in (models.logistic_regression(400), models.random_forest(n_estimators=3, max_depth=3), Pipeline(stages=[models.logistic_regression(400)])):
        assert sum(counted(models.fit(estimator, df), df).values()) == 400
    mean, spread = models.cross_validate(df, models.logistic_regression(400), ["id"], folds=2)
    assert 0.7 < mean <= 1 and spread >= 0
    _, best = models.grid_search(df, "random_forest", ["id"], grid={"n_estimators": [2], "class_weight": [None, "balanced"]}, folds=2)
    assert sum(counted(best, df).values()) == 400


def test_k_sweep_shares_its_passes(spark, monkeypatch):
    """Passes are those of the slowest k, and what is found agrees with the library for the same clusters."""
    from pyspark.ml.evaluation import ClusteringEvaluator

    df, passes, real = blobs(spark), [], clusters._assigned
    monkeypatch.setattr(clusters, "_assigned", lambda rows, centres: passes.append(sorted(centres)) or real(rows, centres))
    found = {r["k"]: r for r in clusters.k_sweep(df, range(2, 6)).collect()}
    assert passes[0] == [2, 3, 4, 5] and len(passes) < 40 and all(set(b) <= set(a) for a, b in zip(passes, passes[1:]))
    best = next(r for r in found.values() if r["is_best"])
    model = clusters.fit_kmeans(df, best["k"], tries=5)
    assert best["inertia"] == pytest.approx(model.summary.trainingCost, rel=1e-6)
    assert best["silhouette"] == pytest.approx(ClusteringEvaluator().evaluate(model.transform(df)), abs=1e-6)
    assert clusters.k_sweep(df.limit(0)).count() == 0
    one = clusters.k_sweep(df.limit(1), [2]).first()  # fewer points than centres
    assert one["inertia"] == 0 and one["silhouette"] == 0


def test_kmeans_starts_share_their_passes(spark, monkeypatch):
    """All starts take part in one pass; a row of every blob is drawn, as those far apart are likelier."""
    passes, real = [], clusters._assigned
    monkeypatch.setattr(clusters, "_assigned", lambda rows, centres: passes.append(sorted(centres)) or real(rows, centres))
    model = clusters.fit_kmeans(blobs(spark), 3, tries=4)
    assert passes[0] == [0, 1, 2, 3] and len(passes) < 10
    found = model.transform(blobs(spark)).groupBy("cluster").agg(F.count_distinct("prediction").alias("n"), F.count("*").alias("rows")).collect()
    assert len(found) == 3 and all((r["n"], r["rows"]) == (1, 30) for r in found)
    again = type(model)(model.learned)
    assert [c.tolist() for c in again.clusterCenters()] == [c.tolist() for c in model.clusterCenters()]
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], "id long, v array<double>").select(array_to_vector("v").alias("features"))
    assert clusters.fit_kmeans(same, 3, tries=2).summary.trainingCost == 0  # fewer different rows than centres


def test_learning_reads_written_rows(spark, monkeypatch, tmp_path):
    """Each learned step takes passes of its own, which must neither join the rows nor split them again."""
    import os

    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    folder, plans, real = "/root/testdata/sf0.001", [], features.preprocessor
    if not os.path.isdir(folder):
        pytest.skip("needs the given tables")

    def noted(df, *args, **options):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return real(df, *args, **options)

    monkeypatch.setattr(features, "preprocessor", noted)
    monkeypatch.setattr(training, "preprocessor", noted)
    entry.queries()["T12_preprocessor"](SparkSession.getActiveSession() or spark, folder)
    assert len(plans) == 1 and "Join" not in plans[0]
    reviews = spark.range(60).selectExpr("concat('r', id) review_id", "concat('P', id % 4) product_id", "double(id % 5 + 1) rating", "double(id % 5 > 1) is_recommended")
    products = spark.range(4).selectExpr("concat('P', id) product_id", "double(id * 10) price_usd")
    training.prepare(reviews, products, ["review_id"])
    assert len(plans) == 2 and "Join" not in plans[1] and "md5" not in plans[1]


def test_silhouettes_are_compared_by_tiles(spark, monkeypatch):
    """Rows meet tile by tile, over several tiles and partitions, and no task or driver gets them all."""
    import numpy as np

    rng = np.random.default_rng(3)
    rows = [(i, f"k{i}", int(rng.integers(3)), rng.normal(size=3).tolist()) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, name string, cluster int, features array<double>").repartition(3)
    whole = {r["id"]: r["silhouette"] for r in clusters.sampled_silhouette_rows(df, ["id", "name"], 60).collect()}
    monkeypatch.setattr(clusters, "TILE_ROWS", 7)
    x, c = np.array([r[3] for r in rows]), np.array([r[2] for r in rows])
    found = {(r["id"], r["name"]): (r["cluster"], r["silhouette"]) for r in clusters.sampled_silhouette_rows(df, ["id", "name"], 60).collect()}
    assert len(found) == 60
    gaps = np.linalg.norm(x[:, None] - x[None], axis=2)
    for i, name, mine, _ in rows:
        means = {k: gaps[i, c == k].sum() / ((c == k).sum() - (k == mine)) for k in range(3)}
        own = means.pop(mine)
        expected = (min(means.values()) - own) / max(own, min(means.values()))
        assert found[i, name][0] == mine and found[i, name][1] == pytest.approx(expected, abs=1e-6) == pytest.approx(whole[i], abs=1e-6)
    y = rng.normal(size=(9, 3))
    sums = clusters._distance_sums(x[:5].tobytes(), y.tobytes(), np.arange(9) % 2, 2, False)
    assert sums.shape == (5, 2) and sums.sum() == pytest.approx(np.linalg.norm(x[:5, None] - y[None], axis=2).sum())


def test_inertia_keeps_its_digits(spark):
    """Two far groups of whole numbers: the squared distances add up to what can be worked out by hand."""
    df = spark.range(60_000).select(array_to_vector(F.array((F.col("id") % 7 + 1 + F.when(F.col("id") % 3 == 0, 1000.0).otherwise(0.0)))).alias("features"))
    groups = [[i % 7 + 1 for i in range(60_000) if (i % 3 == 0) == far] for far in (True, False)]
    exact = sum(sum(v * v for v in g) - sum(g) ** 2 / len(g) for g in groups)
    assert clusters.fit_kmeans(df, 2, tries=2).summary.trainingCost == pytest.approx(exact, abs=1e-7)


def test_places_of_a_vector_far_wider_than_a_row_could_hold(spark):
    rows = spark.sql("select * from values ('a', 'x'), ('b', 'x'), (null, 'x') as t(c, side)")
    wide = Pipeline(stages=features.hashing_stages(["c", "side"], 1 << 30)).fit(rows).transform(rows)
    seen = {r["c"]: (r["places"], r["total"]) for r in wide.select("c", features.places("hashed_hot").alias("places"), features.total("hashed_hot").alias("total")).collect()}
    assert [seen[c][1] for c in ("a", "b", None)] == [2.0, 2.0, 1.0]
    (side,) = seen[None][0]
    assert all(side in seen[c][0] and len(seen[c][0]) == 2 and seen[c][0] == sorted(seen[c][0]) for c in "ab")


def test_places_leave_out_stored_zeros(spark):
    from pyspark.ml.linalg import Vectors

    vectors = [Vectors.sparse(5, [1, 3], [0.0, 2.0]), Vectors.dense(1.0, 0.0, -1.0), Vectors.sparse(3, [], []), Vectors.dense([])]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], ["i", "v"])
    rows = df.select("i", features.places("v").alias("places"), features.total("v").alias("total")).orderBy("i").collect()
    assert [(r["places"], r["total"]) for r in rows] == [([3], 2.0), ([0, 2], 0.0), ([], 0.0), ([], 0.0)]


def test_rows_of_trees_are_dealt_by_their_numbers(spark, monkeypatch):
    """A single file of sparse rows is gigabytes of numbers to a tree: no task gets more than its share."""
    rows = spark.range(600).coalesce(1).select("id", array_to_vector(F.array((F.col("id") % 7).cast("double"), F.rand(1))).alias("features"), (F.col("id") % 7 > 3).cast("double").alias("label"))
    monkeypatch.setattr(models, "TASK_NUMBERS", 300)
    assert models.spread(rows).rdd.getNumPartitions() == 4
    monkeypatch.setattr(models, "TASK_ROWS", 100)
    assert models.spread(rows).rdd.getNumPartitions() == 6
    seen, real = [], type(models.random_forest()).fit
    monkeypatch.setattr(type(models.random_forest()), "fit", lambda self, df: seen.append(df.rdd.getNumPartitions()) or real(self, df))
    model = models.fit(Pipeline(stages=[models.random_forest(n_estimators=2, max_depth=2, max_features=None)]), rows)
    assert seen == [6] and model.transform(rows).where("prediction <> label").count() == 0
    few = rows.where("id < 90")
    assert models.spread(few) is few


def test_folds_of_trees_are_cached_narrow_and_dealt(spark, monkeypatch):
    monkeypatch.setattr(models, "TASK_ROWS", 100)
    rows = spark.range(600).coalesce(1).select("id", F.lit("long text").alias("other"), array_to_vector(F.array((F.col("id") % 7).cast("double"))).alias("features"), (F.col("id") % 7 > 3).cast("double").alias("label"))
    folded = models._folded(rows, models.gradient_boosting(), "label", ["id"], 3, 42)
    assert folded.columns == ["features", "label", "fold"] and folded.rdd.getNumPartitions() == 6
    plain = models.stratified_folds(rows, "label", ["id"], 3, 42)
    assert sorted(tuple(r) for r in folded.groupBy("label", "fold").count().collect()) == sorted(tuple(r) for r in plain.groupBy("label", "fold").count().collect())
    assert models.cross_validate(rows, models.gradient_boosting(n_estimators=2), ["id"], folds=3) == (1.0, 0.0)


def test_fits_share_memory_only_while_cores_are_idle(spark, monkeypatch):
    """Each fit keeps a copy of its rows: where one has tasks for all cores, a second one would only push it to disk."""
    cores = spark.sparkContext.defaultParallelism
    for partitions, wanted in ((1, min(4, cores)), (cores, 1), (cores * 5, 1)):
        assert models.fits_at_a_time(spark.range(100).repartition(partitions), 4) == wanted
    rows = noisy(spark, 200).select("id", "features", "label")
    monkeypatch.setattr(models, "tree_tasks", lambda df: cores)
    running, most, real = [], [], models.fit

    def watched(estimator, df):
        running.append(1)
        most.append(len(running))
        try:
            return real(estimator, df)
        finally:
            running.pop()

    monkeypatch.setattr(models, "fit", watched)
    models.cross_validate(rows, models.gradient_boosting(n_estimators=1), ["id"], folds=3)
    assert most == [1, 1, 1]


def test_rows_of_trees_are_dealt_once(spark, monkeypatch):
    """All passes of a fit read the dealt rows, without columns it does not need; nothing stays behind."""
    rows = noisy(spark, 200).withColumn("text", F.lit("not learned from"))
    monkeypatch.setattr(models, "TASK_ROWS", 100)
    seen, real = [], type(models.random_forest()).fit
    monkeypatch.setattr(type(models.random_forest()), "fit", lambda self, df: seen.append((df.columns, df.storageLevel.useDisk, df.rdd.getNumPartitions())) or real(self, df))
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    models.fit(models.random_forest(n_estimators=2, max_depth=2), rows)
    assert seen == [(["features", "label"], True, 2)] and spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_lines_are_shuffled_once_for_orders_and_buyers(spark):
    """The buyers join the orders first, and the digest of a line is made before the lines move."""
    from shelfsight.workload import q_models, roles

    d, before = "/root/testdata/sf0.001", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        steps = [s.strip(" :+-") for s in q_models.labelled_reviews(spark, d)._jdf.queryExecution().sparkPlan().toString().splitlines()]
        assert [("l_orderkey" in s, "o_custkey" in s) for s in steps if "SortMergeJoin" in s] == [(True, False), (False, True)]
        assert [i for i, s in enumerate(steps) if "md5(" in s][0] > [i for i, s in enumerate(steps) if "SortMergeJoin" in s][0]
        given = q_models.labelled_reviews(spark, d)
        wanted = roles.raw_reviews(spark, d).withColumn(q_models.ID, F.md5(F.concat_ws("|", *roles.REVIEW_ORDER)))
        shown = [q_models.ID, "product_id", "author_id", "rating", "review_text", "skin_tone"]
        assert given.count() == wanted.count() == spark.read.parquet(f"{d}/lineitem.parquet").count()
        assert given.select(shown).exceptAll(wanted.select(shown)).isEmpty()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
