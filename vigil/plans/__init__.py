"""Query plans: the registry of named queries over the given tables, and
their DuckDB oracle SQL (independent formulations of the same results)."""
