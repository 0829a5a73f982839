"""Column expressions and row rules shared by the operators."""
