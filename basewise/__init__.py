"""Spark-native analytics for bacterial-isolate variants and training data."""
