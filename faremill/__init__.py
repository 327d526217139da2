"""faremill: trip analytics and incremental loading as ordinary Spark jobs."""
