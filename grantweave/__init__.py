"""Grant outcome counts and keyword enrichment, expressed as Spark DataFrame jobs."""
