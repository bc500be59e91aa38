"""Column expressions on geometry values."""
