"""Column expressions: cleaning scalars and derived-indicator formulas."""
