"""Column builders (stateless, built-in expressions only)."""
