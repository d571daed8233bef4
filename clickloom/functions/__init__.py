"""Column functions shared by the analyses; all built from JVM-side expressions."""
