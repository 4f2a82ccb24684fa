"""Keyword revenue attribution for clickstream hits on Apache Spark."""
