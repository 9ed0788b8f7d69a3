"""Column builders: every function takes columns and returns a column that stays on the JVM side."""
