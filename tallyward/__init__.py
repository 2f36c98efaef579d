"""Transaction-fraud analytics as Spark jobs."""
