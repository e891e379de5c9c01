"""Column expressions and the numeric model."""
