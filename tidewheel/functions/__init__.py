"""Column expressions: text, similarity, geography, time."""
