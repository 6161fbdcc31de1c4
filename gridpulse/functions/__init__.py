"""Column expressions. All are built-in Catalyst expressions: no Python runs per row."""
