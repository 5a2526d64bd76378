"""Column expressions.  All JVM-side; no Python code runs per row."""
