"""Column expressions (no DataFrame in, one Column out)."""
