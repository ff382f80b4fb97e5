"""Column expressions and Python functions used inside jobs."""
