"""Whole jobs made of operators, and the registry of runnable queries."""
