"""Column functions: all built-in expressions, inside code generation where Spark allows it."""
