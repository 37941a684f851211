"""Column expressions: cleaning, composite keys, file sizes, bins."""
