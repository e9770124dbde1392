"""Column expressions: lenient casts, cleaning rules, file names."""
