"""Column expressions. All are built-in Spark functions, so they stay inside code generation."""
