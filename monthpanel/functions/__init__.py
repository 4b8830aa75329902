"""Column expressions: text, numbers, months and statistics."""
