"""The operators run on the given tables, each with an equal SQL query."""
