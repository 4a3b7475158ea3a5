"""Column expressions: conversions that never throw, and the risk rules."""
