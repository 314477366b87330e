"""Operators: pure DataFrame -> DataFrame functions (sinks take paths)."""
