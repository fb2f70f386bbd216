"""Column-level functions; every one returns a Column and stays inside code generation."""
