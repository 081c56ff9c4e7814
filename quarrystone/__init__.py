"""Spark-native analytics over versioned, report-style public data."""
