"""Sales star schema on Spark: merge sources, build the star, check it, report on it."""
