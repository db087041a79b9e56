"""Model graph, contract queries and their DuckDB oracle SQL."""
