"""Column expressions: times, ids and coordinates."""
