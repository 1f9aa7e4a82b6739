"""Column functions: text, arrays and numbers."""
