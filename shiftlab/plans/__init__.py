"""Whole reports, from input tables to documents."""
