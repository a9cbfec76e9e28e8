"""Article ingestion and semantic retrieval as Spark DataFrame jobs."""
