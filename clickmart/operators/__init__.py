"""Layer operators: pure DataFrame -> DataFrame functions."""
