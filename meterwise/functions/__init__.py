"""Column expressions: calendar, codes, text, geometry, tail probabilities."""
