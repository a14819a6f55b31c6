"""Spark-native preparation, auditing and scoring of text pairs."""
