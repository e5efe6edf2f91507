"""Business-metrics library for PySpark: ingest, star schema, metric catalogue."""
