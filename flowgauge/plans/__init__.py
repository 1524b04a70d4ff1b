"""Whole jobs made from the operators, and the driver's query list."""
