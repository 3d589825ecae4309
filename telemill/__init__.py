"""telemill: a job-telemetry lake as plain Spark DataFrame jobs."""
