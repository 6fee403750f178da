"""Spark-first analytics: queries, typed tables, streams, change sets and JSON Schema verification."""
