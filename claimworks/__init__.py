"""Insurance-claims lakehouse jobs on Spark: ingest, clean, upsert, enrich, train."""
