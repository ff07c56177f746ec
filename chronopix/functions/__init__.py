"""Column functions: bit flags, dates, vectors, geometry, names."""
