"""Two-condition variant-cohort analytics on Spark."""
