"""Spark-native warehouse loading and clinical-note analytics."""
