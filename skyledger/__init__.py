"""Spark-native analytics engine for environmental sensor streams."""
