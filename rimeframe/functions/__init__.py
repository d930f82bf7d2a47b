"""Column expressions: no row functions in Python, so everything stays in generated code."""
