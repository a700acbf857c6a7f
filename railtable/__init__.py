"""Spark-native building and auditing of rail-network data."""
