"""Column-level functions (text, calendar, keys, categories, formatting)."""
