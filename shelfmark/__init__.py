"""Spark-native engine for cleaning, de-duplicating and reconciling library metadata."""
