"""Sales-funnel analytics on Spark: sources, staging, marts and their refresh."""
