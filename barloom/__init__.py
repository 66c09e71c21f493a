"""Barloom: a Spark-native engine for market-data quality, features and temporal splits."""
