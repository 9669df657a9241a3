"""Spark-native reconciliation of service inventories."""
