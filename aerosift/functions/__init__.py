"""Column-level helpers (pure expressions, all JVM-side)."""
