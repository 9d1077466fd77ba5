"""Sales forecast (P23-P27): panel features, holdout split, candidate
tuning and a recursive multi-day forecast, all as Spark jobs."""
