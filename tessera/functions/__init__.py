"""Column expressions that are no operator of their own."""
