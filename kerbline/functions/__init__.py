"""Column expressions: no job, no Python worker."""
