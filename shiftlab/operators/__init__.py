"""Joins, groupings and filters the reports are made of."""
