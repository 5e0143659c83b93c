"""Column expressions. All stay inside Catalyst: no Python runs per row."""
