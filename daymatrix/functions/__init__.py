"""Column expressions: cleaning, naming and code ranges."""
