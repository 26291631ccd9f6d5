"""Column-level helpers: safe casts, exact ratios, code labels, calendar windows."""
