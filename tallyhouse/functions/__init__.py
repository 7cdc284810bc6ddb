"""Column-level building blocks. Every function returns a Column built from JVM-side functions."""
