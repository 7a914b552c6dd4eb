"""Product-review analytics as Spark jobs: clean, validate, join, profile, sample, score, train, evaluate."""
