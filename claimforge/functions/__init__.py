"""Column expressions: keyed randomness, text rendering, query templates."""
