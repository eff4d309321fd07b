"""Station climate data on Spark: scan, clean, aggregate, impute, measure, check."""
