"""Column expressions; all of them run in the JVM."""
