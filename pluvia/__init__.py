"""Daily time-series jobs on Spark: raw documents to features, statistics and next-day predictions."""
