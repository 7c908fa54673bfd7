"""Spark-native medallion library for time-stamped area snapshots."""
