"""Spark-native cohort and recording analytics."""
