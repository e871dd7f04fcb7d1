"""Spark-native processing of clinical record bundles."""
