"""Span annotation pipelines as Spark DataFrame operators."""
