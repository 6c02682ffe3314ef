"""Column -> Column functions and per-document algorithms."""
