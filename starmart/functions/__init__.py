"""Column expressions: cleaning, tolerant typing and exact money arithmetic."""
