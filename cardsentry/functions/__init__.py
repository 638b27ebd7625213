"""Scalar column expressions (all JVM-side)."""
