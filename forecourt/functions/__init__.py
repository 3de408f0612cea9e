"""Column expressions shared by all layers (no UDFs)."""
