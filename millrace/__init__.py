"""Spark-native analysis and reconciliation of large web-page corpora."""
