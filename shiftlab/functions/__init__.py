"""Column functions; all stay in generated JVM code."""
