"""Column expressions and plain-Python text rules shared by the operators."""
