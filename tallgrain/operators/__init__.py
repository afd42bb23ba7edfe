"""Column and table operators."""
