"""Column → Column building blocks."""
