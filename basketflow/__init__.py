"""Spark jobs for retail price panels: ingest, quality, price indices, forecasts."""
