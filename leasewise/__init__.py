"""Subscription and rental commerce analytics as PySpark DataFrame operators."""
