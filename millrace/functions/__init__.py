"""Column expressions: text splitting, JSON messages and time."""
