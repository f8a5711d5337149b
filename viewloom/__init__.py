"""Spark-native analytics for multi-view correspondence data."""
