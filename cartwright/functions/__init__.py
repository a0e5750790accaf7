"""Column -> Column functions. No Python row functions: all stay in the JVM."""
