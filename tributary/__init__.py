"""Spark-native record linkage, tabular analytics and data preparation."""
