"""Text analytics for online communities, written as Spark jobs."""
