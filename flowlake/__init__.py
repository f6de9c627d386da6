"""Flow analytics on Spark: typed ingestion, quality, marts, models and drift."""
