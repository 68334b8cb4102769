"""Column expressions: clock arithmetic, message values, media headers, names and paths."""
