"""Column-level building blocks (all JVM-side, codegen-friendly)."""
