"""Promotion-response analytics on Spark: features, uplift, value, targeting, evaluation."""
