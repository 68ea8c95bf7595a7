"""Column expressions: tolerant casts, defaults, keys and calendar parts."""
