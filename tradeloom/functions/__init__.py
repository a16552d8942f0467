"""Column expressions shared by all plans."""
