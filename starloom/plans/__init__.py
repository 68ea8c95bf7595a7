"""Whole jobs composed from the operators: star build, reports, checks."""
