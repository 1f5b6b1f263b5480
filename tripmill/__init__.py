"""Trip-record analytics on Spark: ingest, warehouse models, checks, streams and event archives."""
