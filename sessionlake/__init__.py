"""Spark-native analytics for coding-agent session history."""
