"""Spark-native analysis of streams of page edits."""
