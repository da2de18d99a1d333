"""Spark-native Bronze -> Silver batch loads for five commerce entities."""
