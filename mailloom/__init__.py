"""Contact and campaign analytics as Spark jobs."""
