"""Whole reports, from input tables to output."""
