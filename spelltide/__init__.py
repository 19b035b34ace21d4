"""Membership months, claims triangles and table toolkit as Spark DataFrame functions."""
