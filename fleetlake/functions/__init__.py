"""Column-level expressions (JVM-side, whole-stage codegen friendly)."""
