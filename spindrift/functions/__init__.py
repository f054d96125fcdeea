"""Column functions: every one builds a Catalyst expression, none runs Python per row."""
