"""Column expressions used by the jobs."""
