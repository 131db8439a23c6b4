"""Column functions: parsing, units, chemistry heuristics, hashing."""
