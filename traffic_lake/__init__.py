"""Ingestion, enrichment, quality checks and profiling of traffic alerts on Spark."""
