"""Column functions. Everything here returns a native Spark expression; nothing runs a job."""
