"""Column functions; every one is a composition of built-in JVM expressions."""
