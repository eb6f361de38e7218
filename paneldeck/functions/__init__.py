"""Column-level helpers (JVM-side expressions) and small numeric helpers."""
