"""Source-code lineage analytics as Spark jobs."""
