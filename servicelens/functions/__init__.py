"""Column expressions and reusable distributed building blocks."""
