"""Metadata-driven tabular ingestion as composable Spark DataFrame operators."""
