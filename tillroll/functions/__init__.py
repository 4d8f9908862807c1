"""Column-expression helpers (exact money, rounding, special functions)."""
