"""Whole jobs wired from the operators, and the registered queries."""
