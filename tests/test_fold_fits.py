"""How many fits of folds run together."""

import time

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from shelfsight.operators import models


def test_linear_fits_run_two_at_a_time(spark, monkeypatch):
    """Their copies are narrow, so one fills the cores that the other leaves idle between its passes; trees still run alone."""
    rows = spark.range(80).select("id", (F.col("id") % 2).cast("double").alias("label"), array_to_vector(F.array((F.col("id") % 2).cast("double"))).alias("features"))
    monkeypatch.setattr(models, "fits_at_a_time", lambda folded, most: 1)
    running, real = [], models.fit

    def watched(estimator, df):
        running.append(1)
        most.append(len(running))
        try:
            time.sleep(0.5)
            return real(estimator, df)
        finally:
            running.pop()

    monkeypatch.setattr(models, "fit", watched)
    for estimator, wanted, at_a_time in ((models.logistic_regression(80), 2, 4), (models.logistic_regression(80), 1, 1), (models.random_forest(n_estimators=1), 1, 4)):
        most = []
        assert models.cross_validate(rows, estimator, ["id"], folds=2, parallelism=at_a_time) == (1.0, 0.0)
        assert max(most) == wanted
