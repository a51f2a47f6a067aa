"""Spark-native validation of tabular file drops against declared column contracts."""
