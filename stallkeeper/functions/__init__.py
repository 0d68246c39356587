"""Column expressions: every function maps Columns to a Column and stays inside the JVM."""
