"""Sales analytics on Spark: ingest, clean, dedupe, summarise and serve orders."""
