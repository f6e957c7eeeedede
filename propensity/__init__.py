"""Customer-propensity features, checks, training sets, models and audiences on Spark."""
