"""Service-level analytics for request feeds, as Spark jobs and DataFrame functions."""
