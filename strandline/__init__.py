"""Spark-first analytics for long reads, assembly graphs and text corpora."""
