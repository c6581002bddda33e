"""Whole jobs, as chains of operators."""
