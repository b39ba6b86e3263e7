"""Operators on long cubes, DataFrame in and DataFrame out."""
