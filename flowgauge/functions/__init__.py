"""Column expressions: code tables, calendar parts, numeric rules."""
