"""Column functions. Every one is a composition of built-in expressions."""
