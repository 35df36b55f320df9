"""Column expressions: null rules, text and time helpers."""
