"""Spark-native temporal compositing and training-data preparation."""
