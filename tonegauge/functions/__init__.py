"""Column expressions. Every one is a built-in Spark expression, no Python functions run per row."""
