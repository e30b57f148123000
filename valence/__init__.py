"""Sentiment scoring and reporting on Spark, in batch and in streaming."""
